"""Option lists offered by the report filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationhour.functions.periods import month_name
from stationhour.functions.scalar import direction_letter, upper_type
from stationhour.operators.selection import lane_type_rank


def years(df: DataFrame) -> DataFrame:
    return df.where("year IS NOT NULL").select("year").distinct().orderBy("year")


def months(df: DataFrame) -> DataFrame:
    """Months present, in calendar order."""
    present = df.where("month_num IS NOT NULL").select("month_num").distinct()
    return present.withColumn("month", month_name(F.col("month_num"))).orderBy("month_num")


def hours(df: DataFrame) -> DataFrame:
    """Smallest and largest hour, 0 and 23 without data."""
    return df.agg(F.coalesce(F.min("hour"), F.lit(0)).alias("min_hour"),
                  F.coalesce(F.max("hour"), F.lit(23)).alias("max_hour"))


def routes(df: DataFrame) -> DataFrame:
    return df.where("route IS NOT NULL").select("route").distinct().orderBy(F.col("route").cast("double"))


def lane_types(df: DataFrame) -> DataFrame:
    """Lane types per route: ML, HV, then the others alphabetically; ``is_default`` marks the first."""
    found = (df.where("type IS NOT NULL").select("route", upper_type().alias("lane_type")).distinct()
             .withColumn("rank", lane_type_rank(F.col("lane_type"))))
    # a route has a handful of lane types
    per_route = found.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("rank", "lane_type"))).alias("types"))
    return (per_route.select("route", F.posexplode("types").alias("position", "t"))
            .select("route", "position", "t.lane_type", (F.col("position") == 0).alias("is_default"))
            .orderBy("route", "position"))


def directions(df: DataFrame) -> DataFrame:
    """Per route the axis of its directions and the default direction; N/S wins over E/W."""
    letters = df.where("direction IS NOT NULL").select("route", direction_letter().alias("letter")).distinct()
    axes = letters.groupBy("route").agg(
        F.array_sort(F.collect_list("letter")).alias("found"),
        F.max(F.col("letter").isin("N", "S")).alias("north_south"),
        F.max(F.col("letter").isin("E", "W")).alias("east_west"))
    axis = F.when(F.col("north_south"), "NS").when(F.col("east_west"), "EW")
    return axes.select("route", F.array_join("found", ",").alias("letters"), axis.alias("axis"),
                       F.substring(axis, 1, 1).alias("default_direction")).orderBy("route")


def stations(df: DataFrame) -> DataFrame:
    """Distinct (station, abs_pm) in post-mile order; rows without a post mile drop out.

    Where no row has a post mile, all stations in the order of their text.
    """
    found = df.dropna(subset=["station"]).select("station", "abs_pm").distinct()
    located = found.agg(F.max(F.col("abs_pm").isNotNull()).alias("located"))
    # a single row is broadcast
    return (found.join(F.broadcast(located), F.col("abs_pm").isNotNull() | ~F.col("located")).drop("located")
            .orderBy("abs_pm", F.col("station").cast("string")))


def post_mile_bounds(df: DataFrame) -> DataFrame:
    """Per route and direction the extent of its post miles, also rounded outwards."""
    found = df.dropna(subset=["abs_pm"]).groupBy("route", direction_letter().alias("letter")).agg(
        F.min("abs_pm").alias("min_pm"), F.max("abs_pm").alias("max_pm"))
    return found.withColumns({"low": F.floor("min_pm").cast("double"), "high": F.ceil("max_pm").cast("double")})


def year_index(df: DataFrame, palette: int = 10) -> DataFrame:
    """Colour index of each distinct year: its rank, modulo the size of the palette."""
    ordered = df.where("year IS NOT NULL").agg(F.array_sort(F.collect_set("year")).alias("years"))
    return (ordered.select(F.posexplode("years").alias("position", "year"))
            .select("year", (F.col("position") % palette).alias("color_index")))
