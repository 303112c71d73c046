"""Raw station-hour text files: discovery, scan, quarantine."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from datetime import datetime
from itertools import takewhile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationhour.functions.periods import in_name_period, name_period, with_name_period
from stationhour.functions.scalar import local_timestamp, nan_to_null
from stationhour.schemas import INT_RAW, PERIOD, RAW_COLUMNS, RAW_SCHEMA, RAW_TEXT_SCHEMA, Params
from stationhour.session import write_shared

RAW_GLOB = "*.{txt,gz}"
ANOTHER_MONTH = "another month"


def root_of(spark: SparkSession, folder: str) -> str:
    """The path of ``folder``, of a pattern the part before its first wildcard, without scheme and authority."""
    fixed = "/".join(takewhile(lambda part: not re.search(r"[*?{\[]", part), folder.rstrip("/").split("/"))) or "/"
    path = spark._jvm.org.apache.hadoop.fs.Path(fixed)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath().rstrip("/")


def file_id(path: Column, root: str) -> Column:
    """What a file goes by: its path below ``root``, or its name where it is the root itself. Files of one name in two folders differ;
    a file that is sent again does not, also below another root."""
    local = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(local.startswith(root + "/"), F.substr(local, F.lit(len(root) + 2))).otherwise(F.element_at(F.split(local, "/"), -1))


def decoded(path: Column) -> Column:
    """A path as listings have it, from the escaped one of a row's metadata."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def with_file_ids(listed: DataFrame, root: str) -> DataFrame:
    """From a listing (path, modificationTime, length): file, file_path, file_name, bytes, modified, year, month_num, month. Files whose name
    holds no valid period drop out."""
    named = listed.select(file_id(F.col("path"), root).alias("file"), F.col("path").alias("file_path"),
                          F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"),
                          F.col("modificationTime").alias("modified"))
    return with_name_period(named).where("month_num IS NOT NULL")


def discover_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files below ``folder`` as (file, file_path, file_name, bytes, modified, year, month_num, month).

    Only the listing is read, not the content. Files whose name holds no valid period drop out.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", RAW_GLOB).load(folder)
    return with_file_ids(listed, root_of(spark, folder)).orderBy("file_path")


EMPTY = hashlib.sha256(b"").hexdigest()


def emptied_files(spark: SparkSession, folder: str, known: Iterable[tuple]) -> list[dict]:
    """Those of the ``known`` files (file, file_name, year, month_num) that are there without a byte, as a listing. Spark's listings leave such files
    out; each file is looked up by its name."""
    root, hadoop = root_of(spark, folder), spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder.split("*")[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for file, name, year, month in known:
        path = fs.makeQualified(hadoop.Path(f"{root}/{file}"))
        if fs.exists(path) and fs.getFileStatus(path).getLen() == 0:
            changed = datetime.fromtimestamp(fs.getFileStatus(path).getModificationTime() / 1000)
            found.append({"file": file, "file_path": path.toString(), "file_name": name, "bytes": 0, "modified": changed, "year": year, "month_num": month})
    return found


def digests(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(file_path, digest): SHA-256 of each file's content as it is stored."""
    content = spark.read.format("binaryFile").load(list(paths))
    return content.select(F.col("path").alias("file_path"), F.sha2("content", 256).alias("digest"))


def latest_files(files: DataFrame) -> DataFrame:
    """The last path of each period in lexical order."""
    return files.groupBy(*PERIOD).agg(
        F.max("file_path").alias("file_path"),
        F.max_by("file_name", "file_path").alias("file_name"))


def _with_origin(rows: DataFrame) -> DataFrame:
    year, month = name_period(F.col("file_name"))
    return rows.withColumns({"file_year": year, "file_month_num": month})


def whole(value: Column) -> Column:
    """A number with no fraction as INT, whether written 1201 or 1201.0; anything else is null."""
    return F.when(value == F.floor(value), value).try_cast("int")


def typed(rows: DataFrame) -> DataFrame:
    """Raw text rows with whole numbers as INT and NaN as null. ``pct_obs`` stays as read, so that its filter reaches the scan."""
    return nan_to_null(rows.withColumns({c: whole(F.col(c)) for c in INT_RAW}), keep=["pct_obs"])


def scan_raw(spark: SparkSession, paths: str | Iterable[str], *, origin: bool = False,
             glob: str | None = None) -> DataFrame:
    """Headerless CSV, plain or gzip. Missing trailing fields are null, NaN is null.

    With ``origin`` the rows also carry file_path, file_name and the period in the name.
    Unused columns are pruned by the reader.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(RAW_TEXT_SCHEMA).option("mode", "PERMISSIVE")
    rows = reader.option("pathGlobFilter", glob or RAW_GLOB).csv(paths)
    if not origin:
        return typed(rows)
    named = rows.select("*", F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_name").alias("file_name"))
    return _with_origin(typed(named))


def _with_reason(rows: DataFrame, params: Params) -> DataFrame:
    """Lines (record, file_path, file_name) with their fields and the reason why a strict reader would refuse them, null of good ones."""
    rows = rows.withColumn("fields", F.split("record", ","))
    text = [i for i, f in enumerate(RAW_SCHEMA) if f.dataType.typeName() == "string"]
    numbers = F.filter("fields", lambda value, i: ~i.isin(*text))
    integers = F.array(*[F.get("fields", F.lit(RAW_COLUMNS.index(c))) for c in INT_RAW])
    unreadable = (F.exists(numbers, lambda value: (F.trim(value) != "") & value.try_cast("double").isNull())
                  | F.exists(integers, lambda value: (F.trim(value) != "") & whole(value.try_cast("double")).isNull()))
    quality = F.get("fields", F.lit(RAW_COLUMNS.index("pct_obs"))).try_cast("double")
    stamp = local_timestamp(F.get("fields", F.lit(0)))
    used = (quality >= params.min_pct_obs) & ~F.isnan(quality)
    foreign = used & name_period(F.col("file_name"))[1].isNotNull() & ~in_name_period(F.col("file_name"), F.to_date(stamp))
    reason = (F.when(F.size("fields") > len(RAW_COLUMNS), "too many fields")
              .when(unreadable, "unreadable value").when(used & stamp.isNull(), "unreadable time stamp")
              .when(foreign, ANOTHER_MONTH))
    return rows.withColumn("reason", reason)


def _lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    paths = paths if isinstance(paths, str) else list(paths)
    return (spark.read.option("pathGlobFilter", RAW_GLOB).text(paths)
            .select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")))


def quarantine(spark: SparkSession, paths: str | Iterable[str], params: Params = Params()) -> DataFrame:
    """Rows that a strict reader would refuse: (file_path, file_name, reason, record).

    These are rows with too many fields, an unreadable number or a fraction where a whole number belongs, and rows of
    sufficient quality with an unreadable time stamp or, in a file whose name holds a period, one of another month.
    """
    return _with_reason(_lines(spark, paths), params).select("file_path", "file_name", "reason", "record").where("reason IS NOT NULL")


def scan_checked(spark: SparkSession, paths: str | Iterable[str], params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """(typed rows as ``scan_raw`` gives them with their origin, rejected rows as ``quarantine`` does) from one pass over the text.

    Each line is parsed once and written with its typed columns and, if it is refused, with reason and record; both results read what was written. A line is
    cut at every comma, so this is for files without quoted fields.
    """
    lines = _with_reason(_lines(spark, paths).where("record <> ''"), params)
    kinds = {f.name: f.dataType for f in RAW_TEXT_SCHEMA}
    values = [F.nullif(F.get("fields", F.lit(i)), F.lit("")).try_cast(kinds[c]).alias(c) for i, c in enumerate(RAW_COLUMNS)]
    refused = F.col("reason").isNotNull()
    checked = write_shared(lines.select(*values, "file_path", "file_name", "reason", F.when(refused, F.col("record")).alias("record")), "checked-lines")
    rows = _with_origin(typed(checked.drop("reason", "record")))
    return rows, checked.where(refused).select("file_path", "file_name", "reason", "record")


def without_bad_files(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """Strict mode: drop every row of a file that has a quarantined row."""
    return rows.join(write_shared(bad.select("file_path").distinct(), "bad-files"), "file_path", "left_anti")
