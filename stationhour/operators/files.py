"""File bookkeeping: requests, manifests, ledgers, pending months, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationhour.functions.periods import MONTHS, age_in_months, period_date
from stationhour.functions.scalar import round_half_even
from stationhour.schemas import PERIOD

# Fixed value: query part of a listing request.
REQUEST_FORMAT = "%s/?srq=clearinghouse&district_id=%s&yy=%s&type=%s&returnformat=text"


def request_grid(scopes: DataFrame, base_url: str) -> DataFrame:
    """Listing requests: one per file type, district and year of each scope row
    (file_types ARRAY, districts ARRAY, start_year, end_year), years inclusive."""
    grid = (scopes.select(F.explode("file_types").alias("file_type"), "districts", "start_year", "end_year")
            .where(F.col("start_year") <= F.col("end_year"))
            .select("file_type", F.explode("districts").alias("district"), "start_year", "end_year")
            .select("file_type", F.col("district").cast("string").alias("district"),
                    F.explode(F.transform(F.sequence("start_year", "end_year"), lambda y: y.cast("string"))).alias("year")))
    return grid.withColumn("url", F.format_string(REQUEST_FORMAT, F.lit(base_url), "district", "year", "file_type"))


def new_files(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Manifest files that the ledger does not hold yet, told apart by id or, lacking one, by name."""
    identity = F.coalesce("file_id", "file_name")
    known = ledger.select(identity.alias("known")).where("known IS NOT NULL").distinct()
    return (manifest.withColumn("known", identity).join(known, "known", "left_anti")
            .select(*manifest.columns))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("files"),
                        round_half_even(F.coalesce(F.sum("megabites"), F.lit(0.0))).alias("megabites"))


def processed_periods(processed: DataFrame) -> DataFrame:
    """Distinct (year, month_num) of a processed table. ``sources.versions.periods`` has them of a published one without opening a file, and may
    stand for the table here and below."""
    return processed.select(*PERIOD).distinct()


def year_status(processed: DataFrame) -> DataFrame:
    """Per year the processed months (alphabetical) and the missing ones (calendar order)."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    # at most twelve months a year
    done = (processed_periods(processed).where("year IS NOT NULL AND month_num BETWEEN 1 AND 12")
            .groupBy("year").agg(F.collect_list(F.get(names, F.col("month_num") - 1)).alias("done")))
    return done.select("year", F.array_sort("done").alias("processed_months"),
                       F.array_except(names, "done").alias("missing_months"))


def pending_months(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Periods with a raw file that the processed table does not hold: a report on the table. Loading goes by file (``plans.months``)."""
    available = files.select(*PERIOD, "month").distinct()
    return available.join(F.broadcast(processed_periods(processed)), PERIOD, "left_anti")


def with_prefix(keys: DataFrame, prefix: str, column: str = "key") -> DataFrame:
    return keys.where(F.col(column).startswith(prefix))


def object_key(file_type: Column, year: Column, day: Column, file_name: Column) -> Column:
    """Storage key of a processed or raw file, null for other types."""
    raw_folder = F.format_string("%04d-%02d", F.year(day), F.month(day))
    return (F.when(file_type == "processed", F.concat_ws("/", F.lit("processed"), year.cast("string"), file_name))
            .when((file_type == "raw") & day.isNotNull(), F.concat_ws("/", F.lit("raw-rolling"), raw_folder, file_name)))


def retention(files: DataFrame, as_of: str, *, rolling_months: int = 12, retention_days: int = 30,
              upload_enabled: bool = True, upload_raw: bool = True, outcomes: DataFrame | None = None) -> DataFrame:
    """Decide per file (kind, file_name, year, month name) what happens to it on ``as_of``.

    action: upload, skip (raw file beyond the rolling window), disabled, invalid (raw file without
    a usable period) or unknown (other kind). ``key`` is set for uploads. ``delete_local`` holds
    once an upload succeeded or was skipped for age; ``lost`` marks files deleted without a copy.

    ``outcomes`` (key, ok) says which uploads have been tried, the last word on a key being one that succeeded: a file whose upload failed, or is not reported, is kept.
    Without it every upload counts as done.
    """
    today = F.lit(as_of).cast("date")
    day = period_date(F.col("year"), F.col("month"))
    aged = files.withColumns({"file_date": day, "months_ago": age_in_months(today, day)})
    processed, raw = F.col("kind") == "processed", F.col("kind") == "raw"
    enabled = F.when(raw, F.lit(upload_enabled and upload_raw)).otherwise(F.lit(upload_enabled))
    action = (F.when(~enabled, "disabled").when(processed, "upload")
              .when(raw & F.col("file_date").isNull(), "invalid")
              .when(raw & (F.col("months_ago") <= rolling_months), "upload")
              .when(raw, "skip").otherwise("unknown"))
    year = F.coalesce(F.col("year").cast("string"), F.year(today).cast("string"))
    decided = aged.withColumn("action", action)
    upload = F.col("action") == "upload"
    decided = decided.withColumn("key", F.when(upload, object_key(F.col("kind"), year, F.col("file_date"), F.col("file_name"))))
    done = F.lit(True)
    if outcomes is not None:
        known = outcomes.where("key IS NOT NULL").groupBy("key").agg(F.max(F.coalesce("ok", F.lit(False))).alias("uploaded"))
        decided, done = decided.join(known, "key", "left"), F.coalesce("uploaded", F.lit(False))
    delete = raw & ((upload & done) | (F.col("action") == "skip")) & (F.col("months_ago") > retention_days / 30)
    return decided.select(*aged.columns, "action", "key", F.coalesce(delete, F.lit(False)).alias("delete_local"),
                          F.coalesce(delete & ~upload, F.lit(False)).alias("lost"))
