"""Report filters: base predicates and per-route choices with data-driven defaults."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationhour.functions.scalar import direction_letter, upper_type
from stationhour.schemas import RouteChoice, Selection

BOTH = "both"


def period_predicate(selection: Selection) -> Column:
    """Years and months; an empty list does not filter."""
    predicate = F.lit(True)
    if selection.years:
        predicate = predicate & F.col("year").isin(*selection.years)
    if selection.months:
        predicate = predicate & F.col("month_num").isin(*selection.months)
    return predicate


def base_predicate(selection: Selection) -> Column:
    return period_predicate(selection) & F.col("hour").between(*selection.hours)


def filter_base(df: DataFrame, selection: Selection) -> DataFrame:
    return df.where(base_predicate(selection))


def filter_routes(df: DataFrame, selection: Selection) -> DataFrame:
    """Rows of the chosen routes; no chosen route selects nothing."""
    routes = [c.route for c in selection.routes]
    return df.where(F.col("route").isin(*routes) if routes else F.lit(False))


_CHOICE_SCHEMA = T.StructType([
    T.StructField("route", T.IntegerType()), T.StructField("want_type", T.StringType()),
    T.StructField("want_direction", T.StringType()), T.StructField("low_pm", T.DoubleType()),
    T.StructField("high_pm", T.DoubleType()), T.StructField("want_stations", T.ArrayType(T.IntegerType())),
])


def _choices(df: DataFrame, selection: Selection) -> DataFrame:
    """The chosen routes, one row each: as many as a caller lists by hand."""
    rows = []
    for c in selection.routes:
        low, high = c.segment or (None, None)
        rows.append((int(c.route), c.lane_type, c.direction, low, high, [int(s) for s in c.stations]))
    return df.sparkSession.createDataFrame(rows, _CHOICE_SCHEMA)


def lane_type_rank(lane_type: Column) -> Column:
    return F.when(lane_type == "ML", 0).when(lane_type == "HV", 1).when(lane_type.isNotNull(), 2).otherwise(3)


def _flags(df: DataFrame, selection: Selection) -> DataFrame:
    """(route, lane type, letter, station) of the base rows on chosen routes, with what the route's choice says of it.

    Every default and fallback of a report follows from this one aggregate, whose rows are as many as stations.
    """
    base = filter_routes(filter_base(df, selection), selection)
    asked = base.join(F.broadcast(_choices(df, selection)), "route")
    pm = F.col("abs_pm") if "abs_pm" in df.columns else F.lit(None).cast("double")
    in_list = (F.size("want_stations") == 0) | F.array_contains("want_stations", F.col("station"))
    in_segment = ((F.col("low_pm").isNull() | (pm >= F.col("low_pm")))
                  & (F.col("high_pm").isNull() | (pm <= F.col("high_pm"))) & pm.isNotNull())
    return asked.groupBy("route", upper_type().alias("lane_type"), direction_letter().alias("letter"), "station").agg(
        F.first("want_type").alias("want_type"), F.first("want_direction").alias("want_direction"),
        F.max(pm.isNotNull()).alias("has_pm"), F.max(in_segment & in_list).alias("in_segment"), F.max(in_list).alias("in_list"))


def _matching(flags: DataFrame) -> DataFrame:
    """The combinations that match their route's lane type and direction.

    Lane type defaults to ML if present, else HV, else the alphabetically first. Direction defaults to N on a
    north-south route and E on an east-west one; a route with neither has no direction filter.
    """
    route = W.partitionBy("route")
    wanted = F.col("want_type").isNull() | (F.col("lane_type") == F.upper("want_type"))
    first = F.when(wanted, F.struct(lane_type_rank(F.col("lane_type")).alias("rank"), "lane_type"))
    chosen = (flags.withColumn("pick", F.min(first).over(route))
              .where(F.col("pick").isNotNull() & F.col("lane_type").eqNullSafe(F.col("pick.lane_type")))
              .withColumns({"north_south": F.max(F.col("letter").isin("N", "S")).over(route),
                            "east_west": F.max(F.col("letter").isin("E", "W")).over(route)}))
    axis_default = F.when(F.col("north_south"), "N").when(F.col("east_west"), "E")
    on_axis = (F.when(F.col("north_south"), F.col("want_direction").isin("N", "S"))
               .when(F.col("east_west"), F.col("want_direction").isin("E", "W")))
    direction = (F.when(F.col("want_direction") == BOTH, F.lit(None))
                 .when(on_axis, F.col("want_direction")).otherwise(axis_default))
    return chosen.where(direction.isNull() | (F.col("letter") == direction))


def _rows_of(df: DataFrame, selection: Selection, kept: DataFrame) -> DataFrame:
    """Base rows of the kept (route, lane type, letter, station)."""
    base = filter_routes(filter_base(df, selection), selection)
    kept = kept.select(*[F.col(c).alias(f"kept_{c}") for c in ("route", "lane_type", "letter", "station")])
    return base.join(kept, (
        (F.col("route") == F.col("kept_route")) & F.col("station").eqNullSafe(F.col("kept_station"))
        & upper_type().eqNullSafe(F.col("kept_lane_type")) & direction_letter().eqNullSafe(F.col("kept_letter"))), "left_semi")


def filter_route_choices(df: DataFrame, selection: Selection) -> DataFrame:
    """Base filter, then route, lane type and direction of each choice."""
    if not selection.routes:
        return df.where(F.lit(False))
    return _rows_of(df, selection, _matching(_flags(df, selection)))


def filter_lane_type(df: DataFrame, selection: Selection) -> DataFrame:
    """Base filter, route and lane type only."""
    relaxed = replace(selection, routes=tuple(RouteChoice(c.route, c.lane_type, BOTH) for c in selection.routes))
    return filter_route_choices(df, relaxed)


def filter_segment(df: DataFrame, low: float, high: float) -> DataFrame:
    """Rows inside a post-mile segment, limits included; rows without a post mile drop out."""
    return df.where(F.col("abs_pm").between(low, high))


def filter_stations(df: DataFrame, stations: tuple[int, ...]) -> DataFrame:
    return df.where(F.col("station").isin(*stations)) if stations else df


def filter_selection(df: DataFrame, selection: Selection) -> DataFrame:
    """The full report filter.

    Per route, stations with a row inside the segment (default: any post mile) are kept, narrowed
    to the chosen stations. A route where that leaves no station keeps all of them, as does a
    route without any post mile.
    """
    if not selection.routes:
        return df.where(F.lit(False))
    matching = _matching(_flags(df, selection))
    station, route = W.partitionBy("route", "station"), W.partitionBy("route")
    judged = matching.withColumns({c: F.max(c).over(station) for c in ("in_segment", "in_list")}).withColumns({
        "located": F.max("has_pm").over(route), "any_segment": F.max("in_segment").over(route), "any_list": F.max("in_list").over(route)})
    fits = F.when(F.col("located"), F.col("in_segment") | ~F.col("any_segment")).otherwise(F.col("in_list") | ~F.col("any_list"))
    return _rows_of(df, selection, judged.where(fits))
