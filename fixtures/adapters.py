"""Present the given tables in the schemas of this engine (see FIXTURES.md).

Line items become detector rows of ten stations over 2019-2025, events those of five stations in
January 2024, suppliers the station metadata and orders the file listing. Every row is used.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.landing import land_raw
from stationhour.functions.periods import holiday_calendar, month_name
from stationhour.operators.cleaning import clean
from stationhour.operators.enrichment import add_metadata
from stationhour.operators.summary import station_hour_summary
from stationhour.schemas import RAW_COLUMNS, RAW_SCHEMA, Params
from stationhour.session import write_shared

BASE_URL = "https://listing.example.org"
AS_OF = "2025-06-01"


def _letters(st: Column) -> Column:
    return (F.when((st % 5) % 2 == 0, F.when(st < 5, "N").otherwise("S"))
            .otherwise(F.when(st < 5, "E").otherwise("W")))


def _stamp(date: Column, hour: Column) -> Column:
    return F.concat(F.date_format(date, "MM/dd/yyyy"), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))


def _raw(rows: DataFrame) -> DataFrame:
    """Complete to the 42 raw columns: ``gap`` is the first lane without a flow."""
    lanes = {f"flow_{i}": F.when(F.col("gap") > i, 1.0) for i in range(1, 9)}
    rows = rows.withColumns(lanes)
    types, given = {f.name: f.dataType for f in RAW_SCHEMA}, set(rows.columns)
    return rows.select(*[
        F.col(c).cast(types[c]).alias(c) if c in given else F.lit(None).cast(types[c]).alias(c)
        for c in RAW_COLUMNS])


class Inputs:
    """The derived inputs of one scale directory; each attribute is planned when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, wide: bool = False):
        """``wide``: a station for every supplier instead of ten, so that the summary grows with the tables."""
        self.spark, self.sf_dir, self.wide = spark, sf_dir, wide
        self.params = Params(min_days=1) if wide else Params()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def raw_l(self) -> DataFrame:
        st = F.col("st")
        cents = F.round(F.col("l_discount") * 100).cast("int")
        items = self.table("lineitem").withColumn("st", (F.col("l_suppkey") % 10).cast("int"))
        return _raw(items.select(
            (F.col("l_suppkey").cast("int") if self.wide else st).alias("station"), (7 + 5 * (st % 2)).alias("district"), (5 + 17 * (st % 5)).alias("route"),
            _letters(st).alias("direction"),
            F.when(st % 5 == 0, "HV").when(st == 7, "OR").otherwise("ML").alias("type"),
            F.when(st != 9, 0.25 * (1 + st)).alias("length"), (100 - 3 * cents).alias("pct_obs"),
            F.when(F.col("l_orderkey") % 37 != 0, F.round(F.col("l_extendedprice") / 100).cast("int")).alias("flow"),
            (80 - F.col("l_quantity")).alias("speed"), F.round(F.col("l_tax") * 100).cast("int").alias("occupancy"),
            (1 + st % 8).alias("gap"),
            _stamp(F.add_months(F.to_date("l_shipdate"), 288), 5 + F.col("l_linenumber")).alias("time_stamp_string")))

    @cached_property
    def raw_e(self) -> DataFrame:
        st = F.col("st")
        events = self.table("events").withColumn("st", (F.col("user_id") % 5).cast("int"))
        event = F.col("event_id")
        return _raw(events.select(
            st.alias("station"), (7 + 5 * (st % 2)).alias("district"), (5 + 17 * (st % 5)).alias("route"),
            F.when(st % 2 == 0, "N").otherwise("E").alias("direction"),
            F.when(st == 0, "HV").otherwise("ML").alias("type"),
            (0.25 * (1 + st)).alias("length"), (100 - 3 * (event % 9)).alias("pct_obs"),
            F.when(event % 37 != 0, F.round(F.col("value") * 10).cast("int")).alias("flow"),
            (30 + event % 50).alias("speed"), (event % 40).alias("occupancy"), (1 + st % 8).alias("gap"),
            _stamp(F.to_date("ts"), F.hour("ts")).alias("time_stamp_string")))

    @cached_property
    def meta(self) -> DataFrame:
        st = F.col("st")
        number = F.col("s_suppkey").cast("int")
        stations = (self.table("supplier").groupBy((number % 10).alias("st"), (number if self.wide else number % 10).alias("number"))
                    .agg(F.min("s_nationkey").alias("nation")))
        return stations.select(
            F.col("number").alias("station"), (7 + 5 * (st % 2)).alias("district"), (5 + 17 * (st % 5)).alias("route"),
            F.when(st == 3, "X").otherwise(_letters(st)).alias("direction"),
            (1 + F.col("nation")).cast("int").alias("county"), F.concat(F.lit("R"), st.cast("string")).alias("state_pm"),
            F.when(st != 4, (2 * st).cast("double")).alias("abs_pm"),
            (33.5 + st / 16).alias("latitude"), (-118 + st / 16).alias("longitude"))

    @cached_property
    def meta_gap(self) -> DataFrame:
        """Metadata that ends at post mile 15."""
        return self.meta.where("abs_pm IS NULL OR abs_pm <= 15")

    @cached_property
    def calendar(self) -> DataFrame:
        return holiday_calendar(self.spark)

    @cached_property
    def clean(self) -> DataFrame:
        return clean(self.raw_l, self.calendar)

    @cached_property
    def summary(self) -> DataFrame:
        return station_hour_summary(self.clean, self.params)

    @cached_property
    def enriched(self) -> DataFrame:
        return add_metadata(self.summary, self.meta)

    @cached_property
    def processed(self) -> DataFrame:
        """The enriched summary as a written table, which is what reports read."""
        return write_shared(self.enriched, "processed")

    @cached_property
    def landed_l(self) -> str:
        """Folder of gzip text files holding ``raw_l``."""
        return land_raw(self.raw_l)

    @cached_property
    def landed_e(self) -> str:
        return land_raw(self.raw_e)

    @cached_property
    def manifest(self) -> DataFrame:
        """One file per type, district and month with orders; its size grows with its orders."""
        status, day = F.col("o_orderstatus"), F.col("o_orderdate")
        files = self.table("orders").groupBy(
            F.when(status == "F", "station_hour").when(status == "O", "station_5min").otherwise("station_day").alias("file_type"),
            (1 + F.col("o_custkey") % 12).cast("string").alias("district"),
            (F.year(day) + 24).alias("year_num"), F.month(day).alias("month_num")).agg(F.count(F.lit(1)).alias("orders"))
        period = F.concat_ws("_", F.col("year_num").cast("string"), F.lpad(F.col("month_num").cast("string"), 2, "0"))
        return files.select(
            "file_type", "district", F.col("year_num").cast("string").alias("year"), "month_num",
            month_name(F.col("month_num")).alias("month"),
            F.concat(F.lit("d"), F.col("district"), F.lit("_text_"), F.col("file_type"), F.lit("_"), period,
                     F.lit(".txt.gz")).alias("file_name"),
            F.concat_ws("-", "file_type", "district", F.lit("f"), period).alias("file_id"),
            F.format_number(40_000_000 + 110_000 * F.col("orders"), 0).alias("bytes"),
            F.concat(F.lit("/?download="), period, F.lit("&d="), F.col("district")).alias("url"))

    @cached_property
    def responses(self) -> DataFrame:
        """One listing response per type, district and year, as JSON text; at most twelve months each."""
        by_month = self.manifest.select(
            "file_type", "district", "year",
            F.struct("month", F.array(F.struct("file_name", "file_id", "bytes", "url"))).alias("entry"))
        return by_month.groupBy("file_type", "district", "year").agg(
            F.to_json(F.struct(F.map_from_entries(F.collect_list("entry")).alias("data"))).alias("json"))

    @cached_property
    def ledger(self) -> DataFrame:
        """Files fetched up to the end of 2022."""
        return self.whole_ledger.where("CAST(year AS INT) <= 2022")

    @cached_property
    def whole_ledger(self) -> DataFrame:
        return self.manifest.select("file_type", "district", "year", "month", "file_name", "file_id",
                            F.lit(0.0).alias("megabites"), F.col("url").alias("download_url"))
