"""Row filters and derived columns of the cleaning step; one stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationhour.functions.periods import month_name, weekday_name
from stationhour.functions.scalar import computed_once, lane_count, local_timestamp, select_existing
from stationhour.schemas import CLEAN_COLUMNS, Params


def keep_observed(rows: DataFrame, min_pct_obs: float = Params.min_pct_obs) -> DataFrame:
    return rows.where((F.col("pct_obs") >= min_pct_obs) & ~F.isnan("pct_obs"))


def add_date_parts(rows: DataFrame, stamp: str = "time_stamp_string") -> DataFrame:
    """date, year, month, month_num, hour and day_of_week from the local time stamp text."""
    parsed = computed_once(rows, "local_ts", local_timestamp(F.col(stamp)))
    parsed = parsed.withColumns({"date": F.to_date("local_ts"), "hour": F.hour("local_ts")})
    return parsed.withColumns({
        "year": F.year("date"), "month_num": F.month("date"),
        "month": month_name(F.month("date")), "day_of_week": weekday_name(F.col("date")),
    }).drop("local_ts")


def keep_midweek(rows: DataFrame) -> DataFrame:
    """Tuesday to Thursday; rows without a date drop out."""
    return rows.where(F.dayofweek("date").isin(3, 4, 5))


def drop_holidays(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Remove rows on a calendar date. The calendar has some dozen rows per year asked for."""
    return rows.join(F.broadcast(calendar.select("date")), "date", "left_anti")


def add_lanes(rows: DataFrame, rule: str = Params.lane_rule) -> DataFrame:
    return rows.withColumn("lanes", lane_count(rule))


def clean(rows: DataFrame, calendar: DataFrame, params: Params = Params()) -> DataFrame:
    """Quality filter, date parts, mid-week and holiday filters, lane count, final columns.

    Columns named ``file_*`` of a scan with origin are kept.
    """
    kept = add_date_parts(keep_observed(rows, params.min_pct_obs))
    kept = add_lanes(drop_holidays(keep_midweek(kept), calendar), params.lane_rule)
    origin = [c for c in rows.columns if c.startswith("file_")]
    return select_existing(kept, CLEAN_COLUMNS + origin)
