"""Station metadata, processed tables, ledger."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException as SparkException

from stationhour.functions.scalar import nan_to_null
from stationhour.sources import versions
from stationhour.sources.raw import whole
from stationhour.schemas import MANIFEST_SCHEMA, META_KEYS, META_SCHEMA, META_VALUES, PERIOD, PROCESSED_SCHEMA

LOG = logging.getLogger(__name__)
YEARLY_GLOB = "*_station_hour_processed.parquet"


def scan_meta(spark: SparkSession, path: str) -> DataFrame:
    """Station metadata CSV with a header; columns are found by name, not by position."""
    header = spark.read.option("header", True).csv(path)
    types, present = {f.name: f.dataType for f in META_SCHEMA}, set(header.columns)


    def read(name: str) -> Column:
        if types[name] == T.IntegerType():  # a column with gaps may have been written 59.0
            return whole(F.col(name).try_cast("double"))
        return F.col(name).try_cast(types[name])

    return nan_to_null(header.select(*[
        (read(c) if c in present else F.lit(None).cast(types[c])).alias(c) for c in META_KEYS + META_VALUES]))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows with its schema when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MANIFEST_SCHEMA)


def scan_processed(spark: SparkSession, path: str) -> DataFrame:
    """The latest snapshot of the processed table, partitioned by year and month_num."""
    return versions.read(spark, path, PROCESSED_SCHEMA)


def with_expected_columns(df: DataFrame, schema: T.StructType = PROCESSED_SCHEMA) -> DataFrame:
    """Add absent columns as typed nulls."""
    present = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in present}
    return df.withColumns(missing) if missing else df


def scan_yearly_files(spark: SparkSession, folder: str, *, skip_corrupt: bool = True) -> DataFrame:
    """The older layout, one Parquet file per year named ``{year}_station_hour_processed.parquet``.

    Files are read by groups of equal schema and cast to the processed table's types, so that a column may be INT in one year and
    DOUBLE in another. A missing year comes from the file name, other expected columns are null, unknown ones drop out.
    Unreadable files are skipped, with a line in the log, unless ``skip_corrupt`` is off. Without any file there are no rows.
    """
    groups: dict[str, list[str]] = {}
    # one path for each file, a few a year
    listed = spark.read.format("binaryFile").option("pathGlobFilter", YEARLY_GLOB)
    try:
        paths = [r.path for r in listed.load(folder).select("path").orderBy("path").collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        paths = []
    for path in paths:
        try:
            groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
        except (AnalysisException, SparkException, Py4JJavaError) as error:
            if not skip_corrupt:
                raise
            LOG.warning("skipped %s: %s", path, str(error).splitlines()[0])
    result = spark.createDataFrame([], PROCESSED_SCHEMA)
    for group in groups.values():
        rows = spark.read.option("ignoreCorruptFiles", skip_corrupt).parquet(*group)
        named = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)_[^/]*station_hour_processed\.parquet", 1).try_cast("int")
        year = F.coalesce(F.col("year").cast("int"), named) if "year" in rows.columns else named
        full = with_expected_columns(rows.withColumn("year", year))
        result = result.unionByName(full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PROCESSED_SCHEMA]))
    return result


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing in one of them is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def write_months(df: DataFrame, path: str) -> None:
    """Replace exactly the (year, month_num) partitions present in ``df``, all at once."""
    version, present = versions.write_version(df, path)
    versions.publish(df.sparkSession, path, lambda now: versions.with_months(now, version, present, landed=False))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with headers, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_ledger(new_files: DataFrame, path: str) -> None:
    """Add rows to the ledger table."""
    new_files.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST_SCHEMA]).write.mode("append").parquet(path)


def remove_months(spark: SparkSession, path: str, periods: list[tuple[int, int]]) -> None:
    """Remove exactly the given (year, month_num) partitions, where they exist, all at once."""
    versions.publish(spark, path, lambda now: versions.with_months(now, versions.PLAIN, [], periods, landed=False))


def replace_months(df: DataFrame, path: str, periods: list[tuple[int, int]]) -> None:
    """Make the given months of the table what ``df`` holds of them, all at once; a month without rows loses its partition."""
    version, present = versions.write_version(df, path)
    kept = [p for p in present if p in set(periods)]
    versions.publish(df.sparkSession, path, lambda now: versions.with_months(now, version, kept, periods, landed=False))
