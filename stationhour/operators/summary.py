"""Station-hour-month summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationhour.functions.periods import month_name
from stationhour.functions.quantiles import grouped_medians
from stationhour.functions.scalar import nan_to_null
from stationhour.schemas import MEASURES, STATISTICS, SUMMARY_KEYS, Params

# the month name follows from its number and is added after grouping
GROUP_KEYS = [k for k in SUMMARY_KEYS if k != "month"]
INPUT_COLUMNS = [*GROUP_KEYS, *MEASURES]


def _moments() -> list[Column]:
    out = []
    for column, suffix in MEASURES.items():
        out += [F.avg(column).alias(f"avg_{suffix}"), F.stddev_samp(column).alias(f"sd_{suffix}")]
    return [*out, F.count(F.lit(1)).alias("days_observed")]


def _plain(rows: DataFrame) -> DataFrame:
    medians = [F.median(column).alias(f"median_{suffix}") for column, suffix in MEASURES.items()]
    return rows.groupBy(*GROUP_KEYS).agg(*medians, *_moments())


def _split(rows: DataFrame) -> DataFrame:
    medians = grouped_medians(rows, GROUP_KEYS, {
        f"median_{suffix}": F.col(column) for column, suffix in MEASURES.items()}, refine=True)
    return rows.groupBy(*GROUP_KEYS).agg(*_moments()).join(medians, GROUP_KEYS, "left")


def station_hour_summary(clean_rows: DataFrame, params: Params = Params()) -> DataFrame:
    """Median, mean and sample deviation of each measure and the row count per station, hour,
    month and lane count, for groups of at least ``min_days`` rows.

    Rows with a null key drop out; NaN counts as null. ``params.medians`` chooses between two exact ways: "buffered" keeps a
    group's distinct values in one buffer (a detector has some thirty rows an hour and month), in one shuffle; "split" counts
    values first and narrows their ranges step by step (a few jobs), for stations whose groups outgrow a task.
    """
    if params.medians not in ("buffered", "split"):
        raise ValueError(f"unknown medians: {params.medians}")
    rows = nan_to_null(clean_rows.select(*INPUT_COLUMNS).dropna(subset=GROUP_KEYS))
    return finished(_split(rows) if params.medians == "split" else _plain(rows), params)


def finished(summary: DataFrame, params: Params) -> DataFrame:
    """Groups of at least ``min_days`` rows in the summary's layout."""
    return (summary.where(F.col("days_observed") >= params.min_days)
            .withColumn("month", month_name(F.col("month_num")))
            .select(*SUMMARY_KEYS, *STATISTICS, "days_observed"))
