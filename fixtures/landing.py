"""Write derived rows as files whose names follow the conventions of the sources."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationhour.session import shared_path


def _rename(spark, folder: str, name_of, suffix: str, to: str | None = None) -> None:
    """Move ``folder/name=X/part-*`` to ``to/name_of(X, i)``, by default in the same folder; one name per written file."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        label = status.getPath().getName()
        if "=" not in label:
            continue
        parts = [p.getPath() for p in fs.listStatus(status.getPath()) if p.getPath().getName().endswith(suffix)]
        for i, part in enumerate(sorted(parts, key=lambda p: p.getName())):
            target = jvm.org.apache.hadoop.fs.Path(to or folder, name_of(label.split("=", 1)[1], i))
            fs.mkdirs(target.getParent())
            fs.rename(part, target)


def land_raw(rows: DataFrame, filed_as: Column | None = None) -> str:
    """Headerless gzip CSV files ``d{district}_text_station_hour_{yyyy_mm}.txt.gz`` of raw rows; returns the pattern of their folders, as a month too large for
    a file has another of that name in the next folder. ``filed_as`` is the period (yyyy_mm) in the name of a row's file where that is not the row's own."""
    spark = rows.sparkSession
    written, folder = shared_path(spark, "written-raw"), shared_path(spark, "landed-raw")
    stamp = F.col("time_stamp_string")
    label = F.concat_ws("-", F.lpad(F.col("district").cast("string"), 2, "0"),
                        F.coalesce(F.lit(None) if filed_as is None else filed_as, F.concat_ws("_", F.substring(stamp, 7, 4), F.substring(stamp, 1, 2))))
    # a line is far shorter than its row, most of whose columns are null; no text of these rows needs quotes
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    lines = rows.select(line.alias("value"), label.alias("label")).hint("rebalance", "label")
    with _open_files(spark, 256):
        lines.write.partitionBy("label").option("compression", "gzip").text(written)

    def name_of(value: str, i: int) -> str:
        district, period = value.split("-")
        return f"{i}/d{district}_text_station_hour_{period}.txt.gz"

    _rename(spark, written, name_of, ".txt.gz", folder)
    return f"{folder}/*"


@contextmanager
def _open_files(spark: SparkSession, most: int):
    """A task that writes has up to ``most`` files open instead of sorting its rows by file first, in memory that grows with them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land_yearly(processed: DataFrame) -> str:
    """Parquet files ``{year}_station_hour_processed.parquet`` without a year column."""
    spark = processed.sparkSession
    folder = shared_path(spark, "landed-years")
    processed.hint("rebalance", "year").write.partitionBy("year").parquet(folder)
    _rename(spark, folder, lambda year, i: f"{year}_station_hour_processed.parquet" if i == 0
            else f"{year}_part{i}_station_hour_processed.parquet", ".parquet")
    return folder
