"""Incremental ingestion of raw files with Structured Streaming.

Each run takes the files that have arrived since the last one and stops.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stationhour.operators.cleaning import clean
from stationhour.plans.delivery import deliver
from stationhour.plans.months import load_files
from stationhour.schemas import PERIOD, RAW_TEXT_SCHEMA, Params
from stationhour.session import write_shared
from stationhour.sources.raw import RAW_GLOB, discover_files, root_of, typed, with_file_ids

LOG = logging.getLogger(__name__)


def read_raw_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw files as they arrive, with the name of their file."""
    reader = spark.readStream.schema(RAW_TEXT_SCHEMA).option("mode", "PERMISSIVE").option("pathGlobFilter", RAW_GLOB)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return typed(reader.csv(folder).select("*", F.col("_metadata.file_name").alias("file_name")))


def clean_stream(rows: DataFrame, calendar: DataFrame, params: Params = Params()) -> DataFrame:
    """The batch cleaning step on a stream; the calendar is joined as a static table."""
    return clean(rows, calendar, params)


def append_stream(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Append everything available once, exactly once across restarts."""
    (rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


LISTING_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def read_file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw files as they arrive, as a listing (see ``sources.raw.with_file_ids``): files without any row come too."""
    reader = spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("pathGlobFilter", RAW_GLOB)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_file_ids(reader.load(folder), root_of(spark, folder))


def upsert_stream(spark: SparkSession, folder: str, table: str, checkpoint: str, meta: DataFrame, calendar: DataFrame,
                  params: Params = Params(), *, on_missing: str = "drop_month", files_per_batch: int | None = None,
                  after_batch: Callable[[DataFrame, int], None] | None = None,
                  after_file: Callable[[Row], None] | None = None) -> int:
    """Keep the processed table up to date with the raw files of ``folder``.

    A micro-batch is a list of files and goes the way that ``backfill`` goes, into the same states and lists, so both may serve one table and a replayed batch
    finds nothing new. A file stream never returns to a path; files that were sent again under a known one are found when the stream has
    come to its end, by comparing the listing with the files known.

    ``after_batch`` receives the periods of a batch; its errors are logged and do not stop the stream. ``after_file`` receives
    each new or changed file through ``plans.delivery``, until it has gone through. Returns the number of errors of both.
    """
    files, failures = read_file_stream(spark, folder, files_per_batch), 0

    def load(listed: DataFrame, batch_id: int) -> None:
        nonlocal failures
        session = listed.sparkSession
        changed = load_files(session, listed, table, meta, calendar, params, folder=folder, on_missing=on_missing)
        if changed and after_batch is not None:
            try:
                after_batch(listed.select(*PERIOD).distinct(), batch_id)
            except Exception:  # a hook must not interrupt ingestion
                failures += 1
                LOG.exception("a hook failed in batch %s", batch_id)

    (files.writeStream.foreachBatch(lambda batch, n: load(write_shared(batch, "batch"), n)).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    load(discover_files(spark, folder), -1)
    if after_file is not None:
        failures += deliver(spark, table, after_file)[1]
    return failures
