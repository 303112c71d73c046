"""Report metrics over the processed table or a selection of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationhour.functions.periods import month_name, with_every_month
from stationhour.functions.quantiles import grouped_medians
from stationhour.functions.scalar import direction_letter, flow_per_lane, to_number, upper_type
from stationhour.operators.selection import period_predicate
from stationhour.schemas import PERIOD, Selection

ROUTE_YEAR = ["route", "year"]
ROUTE_MONTH = [*ROUTE_YEAR, "month_num"]


def _partial_figures(rows: DataFrame, *keys: str) -> DataFrame:
    """One partial result per station and route: the distinct counts then see few rows."""
    speed, flow = to_number(F.col("avg_speed")), to_number(F.col("avg_flow"))
    return rows.groupBy("station", "route", *keys).agg(
        F.sum(speed).alias("speed_sum"), F.count(speed).alias("speed_n"),
        F.sum(flow).alias("flow_sum"), F.count(flow).alias("flow_n"))


def _total_figures() -> list[Column]:
    mean = lambda name: F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))
    return [F.count_distinct("station").alias("stations"), F.count_distinct("route").alias("routes"),
            mean("speed").alias("avg_speed"), mean("flow").alias("avg_flow")]


def kpis(df: DataFrame) -> DataFrame:
    """Distinct stations and routes, unweighted mean speed and flow: one row."""
    return _partial_figures(df).agg(*_total_figures())


def kpis_global(df: DataFrame, selection: Selection = Selection()) -> DataFrame:
    """Key figures under the year and month filter alone, of ML rows, or of all if there is no ML.

    One scan serves both cases.
    """
    rows = df.where(period_predicate(selection)).withColumn("ml", F.coalesce(upper_type() == "ML", F.lit(False)))
    totals = _partial_figures(rows, "ml").groupBy("ml").agg(*_total_figures())
    # at most two rows; without ML rows the other one covers everything
    figures = F.struct("stations", "routes", "avg_speed", "avg_flow")
    best = totals.agg(F.max_by(figures, F.col("ml").cast("int")).alias("k"))
    return best.select(F.coalesce("k.stations", F.lit(0)).alias("stations"),
                       F.coalesce("k.routes", F.lit(0)).alias("routes"), "k.avg_speed", "k.avg_flow")


# the charts that sums and counts are enough for, and the columns that each of them groups by
CHART_SETS = {"figures": ["station", "route"], "bars": [*ROUTE_MONTH, "letter"], "hours": ["hour", "year"]}


def chart_sums(df: DataFrame) -> DataFrame:
    """Sums and counts of flow and speed for key figures, monthly bars and speed by hour, from one scan: a row for each group of each of ``CHART_SETS``,
    whose name is in ``chart``."""
    speed, flow = to_number(F.col("avg_speed")), to_number(F.col("avg_flow"))
    rows = df.withColumns({"letter": direction_letter(), "speed": speed, "flow": flow})
    keys = list(dict.fromkeys(c for columns in CHART_SETS.values() for c in columns))
    sums = rows.groupingSets([[F.col(c) for c in columns] for columns in CHART_SETS.values()], *keys).agg(
        F.grouping_id().alias("absent"), F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"),
        F.sum("flow").alias("flow_sum"), F.count("flow").alias("flow_n"))
    bits = {name: sum(1 << i for i, c in enumerate(reversed(keys)) if c not in columns) for name, columns in CHART_SETS.items()}
    chart = F.coalesce(*[F.when(F.col("absent") == n, F.lit(name)) for name, n in bits.items()])
    return sums.select(chart.alias("chart"), *keys, "speed_sum", "speed_n", "flow_sum", "flow_n")


def _of_chart(sums: DataFrame, name: str) -> DataFrame:
    return sums.where(F.col("chart") == name).select(*CHART_SETS[name], "speed_sum", "speed_n", "flow_sum", "flow_n")


def kpis_of_sums(sums: DataFrame) -> DataFrame:
    """As ``kpis``."""
    return _of_chart(sums, "figures").agg(*_total_figures())


def speed_by_hour_of_sums(sums: DataFrame) -> DataFrame:
    """As ``speed_by_hour``."""
    known = _of_chart(sums, "hours").where("speed_n > 0").dropna(subset=["hour", "year"])
    return known.select("hour", "year", (F.col("speed_sum") / F.col("speed_n")).alias("avg_speed"))


def route_month_one_way_of_sums(sums: DataFrame, dense: bool = True) -> DataFrame:
    """As ``route_month_one_way``."""
    rows = _route_rows(_of_chart(sums, "bars")).groupBy(*ROUTE_MONTH).agg(F.sum("flow_sum").alias("s"), F.sum("flow_n").alias("n"))
    return _by_month(rows.where("n > 0").select(*ROUTE_MONTH, (F.col("s") / F.col("n")).alias("bar_value")), dense)


def route_month_two_way_of_sums(sums: DataFrame, dense: bool = True) -> DataFrame:
    """As ``route_month_two_way``."""
    rows = _of_chart(sums, "bars").dropna(subset=["route"])
    measured = (F.col("flow_n") > 0) & F.col("year").isNotNull() & F.col("month_num").isNotNull()
    mean_of = lambda letter: F.max(F.when(measured & (F.col("letter") == letter), F.col("flow_sum") / F.col("flow_n")))
    means = rows.groupBy(*ROUTE_MONTH).agg(*[mean_of(letter).alias(letter) for letter in "NSEW"],
                                           F.max(F.col("letter").isin("N", "S")).alias("north_south"), F.max(measured).alias("measured"))
    return _two_way(means, dense)


def every_route_month(values: DataFrame) -> DataFrame:
    """Complete each (route, year) present to twelve months; months without values are null.

    A route-year has at most twelve rows, so they are gathered in one map and spread again.
    """
    columns = [c for c in values.columns if c not in ROUTE_MONTH]
    by_month = values.groupBy(*ROUTE_YEAR).agg(
        F.map_from_entries(F.collect_list(F.struct("month_num", F.struct(*columns)))).alias("by_month"))
    dense = with_every_month(by_month).withColumn("found", F.try_element_at("by_month", F.col("month_num")))
    return dense.select(*ROUTE_MONTH, month_name(F.col("month_num")).alias("month"), "found.*")


def _route_rows(df: DataFrame, *needed: str) -> DataFrame:
    return df.dropna(subset=["route", *PERIOD, *needed])


def _by_month(values: DataFrame, dense: bool) -> DataFrame:
    return every_route_month(values) if dense else values.withColumn("month", month_name(F.col("month_num")))


def route_month_one_way(df: DataFrame, dense: bool = True) -> DataFrame:
    """Mean flow per route, year and month; absent months are null."""
    means = _route_rows(df, "avg_flow").groupBy(*ROUTE_MONTH).agg(F.avg("avg_flow").alias("bar_value"))
    return _by_month(means, dense)


def route_month_two_way(df: DataFrame, dense: bool = True) -> DataFrame:
    """Sum of the two directional mean flows per route, year and month; absent ones count as 0.

    A route with any N or S row sums N and S, others E and W.
    """
    rows = df.dropna(subset=["route"]).withColumn("letter", direction_letter())
    measured = F.col("avg_flow").isNotNull() & F.col("year").isNotNull() & F.col("month_num").isNotNull()
    mean_of = lambda letter: F.avg(F.when(measured & (F.col("letter") == letter), F.col("avg_flow")))
    means = rows.groupBy(*ROUTE_MONTH).agg(
        *[mean_of(letter).alias(letter) for letter in "NSEW"],
        F.max(F.col("letter").isin("N", "S")).alias("north_south"),
        F.max(measured).alias("measured"))
    return _two_way(means, dense)


def _two_way(means: DataFrame, dense: bool) -> DataFrame:
    # twelve rows per route and year: the switch is a property of the whole route
    switched = (means.withColumn("north_south", F.max("north_south").over(W.partitionBy("route")))
                .where("measured"))
    pair = lambda a, b: F.coalesce(F.col(a), F.lit(0.0)) + F.coalesce(F.col(b), F.lit(0.0))
    sums = switched.select(*ROUTE_MONTH, F.when(F.col("north_south"), pair("N", "S"))
                           .otherwise(pair("E", "W")).alias("bar_value"))
    filled = _by_month(sums, dense)
    return filled.withColumn("bar_value", F.coalesce("bar_value", F.lit(0.0)))


def route_month_per_lane(df: DataFrame, dense: bool = True) -> DataFrame:
    """Median flow per lane per route, year and month; absent months are null. A route with any lane count has the months of every year with
    flow, also of one without; a route without any has no line."""
    rows = _route_rows(df.withColumn("per_lane", flow_per_lane(df.columns)), "avg_flow")
    medians = grouped_medians(rows, ROUTE_MONTH, {"line_value": F.col("per_lane"), "flow": F.col("avg_flow")})
    # twelve rows per route and year
    any_lane = F.max(F.col("line_value").isNotNull()).over(W.partitionBy("route"))
    medians = medians.withColumn("any_lane", any_lane).where("any_lane").select(*ROUTE_MONTH, "line_value")
    return _by_month(medians if dense else medians.where("line_value IS NOT NULL"), dense)


def route_month_line(df: DataFrame, dense: bool = True) -> DataFrame:
    """The line of the monthly chart: median flow per lane, or median flow on a route that has no
    per-lane value at all (``per_lane`` tells which)."""
    rows = _route_rows(df.withColumn("per_lane", flow_per_lane(df.columns)), "avg_flow")
    both = grouped_medians(rows, ROUTE_MONTH, {"lane_median": F.col("per_lane"), "flow_median": F.col("avg_flow")})
    # twelve rows per route and year
    any_lane = F.max(F.col("lane_median").isNotNull()).over(W.partitionBy("route"))
    chosen = both.withColumn("per_lane", any_lane).select(
        *ROUTE_MONTH, "per_lane", F.when(F.col("per_lane"), F.col("lane_median"))
        .otherwise(F.col("flow_median")).alias("line_value"))
    if not dense:
        chosen = chosen.where("line_value IS NOT NULL")
    return _by_month(chosen, dense).withColumn("per_lane", F.max("per_lane").over(W.partitionBy("route")))


def _station_points(rows: DataFrame, keys: Sequence[str], mean: str, *others: Column) -> DataFrame:
    """Median position and mean flow per key, in one shuffle: a station has a handful of positions, so the built-in median
    buffers few values however many rows it has."""
    rows = rows.dropna(subset=["latitude", "longitude", *keys])
    return rows.groupBy(*keys).agg(F.avg(to_number(F.col("avg_flow"))).alias(mean), *others,
                                   F.median("latitude").alias("latitude"), F.median("longitude").alias("longitude"))


def station_map(df: DataFrame) -> DataFrame:
    """Map point per station of a filtered selection."""
    return _station_points(df, ["station"], "avg_flow_sel")


def station_map_global(df: DataFrame, selection: Selection = Selection()) -> DataFrame:
    """Map point per station under the year and month filter alone."""
    return station_map(df.where(period_predicate(selection)))


def station_year_month(df: DataFrame, selection: Selection = Selection()) -> DataFrame:
    """Map point per station, year and month, with its district if there is one."""
    rows = df.where(period_predicate(selection)).withColumn("year", to_number(F.col("year"), "int"))
    others = [F.min("district").alias("district")] if "district" in df.columns else []
    return _station_points(rows, ["station", *PERIOD], "avg_flow_ym", *others).withColumn(
        "month", month_name(F.col("month_num")))


def widened(low: Column, high: Column) -> tuple[Column, Column]:
    """A colour domain; a single value is widened by 5 % of its size, or by 1 at zero."""
    delta = F.when(high == 0, 1.0).otherwise(F.abs(high) * 0.05)
    return F.when(low == high, low - delta).otherwise(low), F.when(low == high, high + delta).otherwise(high)


def map_domain(points: DataFrame, value: str = "avg_flow_sel") -> DataFrame:
    """Map centre and colour domain; 0 to 1 when no point has a value."""
    found = points.agg(F.avg("latitude").alias("center_lat"), F.avg("longitude").alias("center_lon"),
                       F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = widened(F.col("low"), F.col("high"))
    return found.select("center_lat", "center_lon", F.coalesce(low, F.lit(0.0)).alias("color_min"),
                        F.coalesce(high, F.lit(1.0)).alias("color_max"))


def speed_by_hour(df: DataFrame) -> DataFrame:
    """Mean speed by hour and year."""
    return df.dropna(subset=["hour", "year", "avg_speed"]).groupBy("hour", "year").agg(
        F.avg("avg_speed").alias("avg_speed"))


def speed_by_hour_pivot(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """Mean speed with one row per hour and one column per listed year."""
    return (df.dropna(subset=["hour", "avg_speed"]).groupBy("hour")
            .pivot("year", list(years)).agg(F.avg("avg_speed")))
