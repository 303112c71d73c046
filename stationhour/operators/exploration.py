"""Exploratory aggregates over the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationhour.functions.numbering import number_rows
from stationhour.functions.periods import MONTHS, month_name
from stationhour.functions.quantiles import quantiles_of_counts, value_counts
from stationhour.functions.scalar import peak_bucket
from stationhour.schemas import SUMMARY_KEYS
from stationhour.session import write_shared

DIRECTIONS = ["N", "S", "E", "W"]
ROW_ORDER = ["year", "month_num", "station", "hour", "district", "route", "direction", "type", "lanes", "length"]


def heatmap_hour_month(df: DataFrame, months: Sequence[str] = tuple(MONTHS)) -> DataFrame:
    """Mean of median_flow with one row per hour and one column per listed month."""
    return df.groupBy("hour").pivot("month", list(months)).agg(F.avg("median_flow"))


def route_counts(df: DataFrame) -> DataFrame:
    return df.where("route IS NOT NULL").groupBy("route").agg(F.count(F.lit(1)).alias("row_count"))


def top_routes(df: DataFrame, k: int = 5) -> DataFrame:
    """The k routes with most rows, smaller route first on ties."""
    return route_counts(df).orderBy(F.desc("row_count"), "route").limit(k)


def top_routes_box(df: DataFrame, k: int = 5, value: str = "median_speed") -> DataFrame:
    """Box statistics per top route: quartiles and whiskers, the furthest values within 1.5
    interquartile ranges of the box, never inside the box. All come from one written count of values."""
    rows = df.join(F.broadcast(top_routes(df, k).select("route")), "route", "left_semi").dropna(subset=[value])
    counts = write_shared(value_counts(rows, ["route"], {value: F.col(value)}), "box-values")
    box = quantiles_of_counts(counts, ["route"], {"q1": (value, 0.25), "median": (value, 0.5), "q3": (value, 0.75)})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    # k rows
    limits = F.broadcast(box.withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach}))
    inside = F.when(F.col("value").between(F.col("low"), F.col("high")), F.col("value"))
    found = counts.join(limits, "route").groupBy("route", "q1", "median", "q3").agg(F.min(inside).alias("least"), F.max(inside).alias("most"))
    return found.select("route", F.least("least", "q1").alias("whisker_low"), "q1", "median", "q3", F.greatest("most", "q3").alias("whisker_high"))


def systematic_sample(df: DataFrame, step: int = 10) -> DataFrame:
    """Every ``step``-th row in full key order, starting with the first."""
    return number_rows(df, ROW_ORDER).where(F.col("row_number") % step == 0)


def hashed_sample(df: DataFrame, step: int = 10) -> DataFrame:
    """About one row in ``step``, chosen by a hash of its key: no order, no shuffle."""
    keys = [c for c in SUMMARY_KEYS if c in df.columns]
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(step)) == 0)


def hour_direction_flow(df: DataFrame) -> DataFrame:
    return (df.where(F.col("direction").isin(*DIRECTIONS)).groupBy("hour", "direction")
            .agg(F.avg("median_flow").alias("avg_median_flow")))


def occupancy_histogram(df: DataFrame, bins: int = 50, lane_types: Sequence[str] = ("ML", "HV"),
                        value: str = "median_occup") -> DataFrame:
    """Density histogram per lane type over equal bins from its minimum to its maximum.

    The last bin is closed, empty bins are present with density 0. A type with one distinct value
    gets a range of one unit around it.
    """
    rows = df.where(F.col("type").isin(*lane_types)).dropna(subset=[value]).select("type", value)
    span = rows.groupBy("type").agg(F.min(value).alias("low"), F.max(value).alias("high"),
                                    F.count(F.lit(1)).alias("total"))
    flat = F.col("low") == F.col("high")
    span = span.select("type", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
                       F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"), "total")
    span = span.withColumn("width", (F.col("high") - F.col("low")) / bins)
    position = F.floor((F.col(value) - F.col("low")) / F.col("width")).cast("int")
    # one row per lane type asked for
    placed = rows.join(F.broadcast(span), "type").withColumn("bin", F.least(position, F.lit(bins - 1)))
    # the quotient may round across an edge: compare with the edges themselves
    edge = lambda i: F.col("low") + i * F.col("width")
    binned = placed.withColumn("bin", F.when(F.col(value) < edge(F.col("bin")), F.col("bin") - 1).when(
        (F.col(value) >= edge(F.col("bin") + 1)) & (F.col("bin") < bins - 1), F.col("bin") + 1).otherwise(F.col("bin")))
    counts = binned.groupBy("type", "low", "width", "total", "bin").agg(F.count(F.lit(1)).alias("n"))
    # as many entries as bins
    by_type = counts.groupBy("type", "low", "width", "total").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))
    dense = by_type.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = dense.withColumn("n", F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)))
    return filled.select("type", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"), "n",
                         (F.col("n") / (F.col("total") * F.col("width"))).alias("density"))


def monthly_trend(df: DataFrame) -> DataFrame:
    """Mean of median_flow per calendar month, in calendar order."""
    means = df.groupBy("month_num").agg(F.avg("median_flow").alias("avg_median_flow"))
    return means.withColumn("month", month_name(F.col("month_num"))).orderBy("month_num")


def peak_off_peak(df: DataFrame) -> DataFrame:
    return df.groupBy(peak_bucket(F.col("hour")).alias("period")).agg(F.avg("median_speed").alias("avg_median_speed"))


# How the summary words its figures.
FLOW_TEXT = "%.0f vehicles/hour"
SPEED_TEXT = "%.1f mph"


def data_summary(df: DataFrame, k: int = 5) -> DataFrame:
    """One row: distinct stations, mean flow and speed (also as text), top routes as text."""
    figures = df.agg(F.count_distinct("station").alias("total_stations"),
                     F.avg("median_flow").alias("flow"), F.avg("median_speed").alias("speed"))
    ranked = top_routes(df, k).agg(F.array_sort(F.collect_list(
        F.struct((-F.col("row_count")).alias("order"), F.col("route")))).alias("ranked"))
    names = F.array_join(F.transform("ranked", lambda r: r["route"].cast("string")), ", ")
    # two single rows become one
    both = figures.unionByName(ranked.select(names.alias("top_routes")), allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return one.select("total_stations",
                      F.when(F.col("flow").isNotNull(), F.format_string(FLOW_TEXT, F.rint("flow"))).alias("average_flow"),
                      F.when(F.col("speed").isNotNull(), F.format_string(SPEED_TEXT, F.col("speed"))).alias("average_speed"),
                      "top_routes")


def stations_on_routes(df: DataFrame, routes: Sequence[int]) -> DataFrame:
    return df.where(F.col("route").isin(*routes)).agg(F.count_distinct("station").alias("stations"))


def metric_domain(df: DataFrame, metric: str = "median_flow") -> DataFrame:
    """Smallest and largest value over all years, for a common colour scale."""
    return df.agg(F.min(metric).alias("color_min"), F.max(metric).alias("color_max"))


def head_tail(df: DataFrame, n: int = 5) -> DataFrame:
    """First and last n rows in full key order, told apart by ``part``."""
    first = df.orderBy(*ROW_ORDER).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.desc(c) for c in ROW_ORDER]).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)
