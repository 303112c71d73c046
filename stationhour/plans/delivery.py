"""Handing each new or changed file of a table to a hook, until it has gone through.

The list of files behind a table is the outbox: a version of a file (its id and digest) that no delivery names is still to be handed
over. Deliveries are kept beside the table, so what failed, or was cut off, is tried again by the next call.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationhour.plans.months import known_files
from stationhour.schemas import PERIOD
from stationhour.session import write_shared
from stationhour.sources.tables import read_or_empty

LOG = logging.getLogger(__name__)
DELIVERED_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("delivered", T.TimestampType()),
])
RECORDED_AT_ONCE = 100


def undelivered(spark: SparkSession, table: str) -> DataFrame:
    """Versions of files (see ``known_files``) that the hook has not taken yet."""
    done = read_or_empty(spark, f"{table.rstrip('/')}/_delivered", DELIVERED_SCHEMA)
    return known_files(spark, table).join(done.select("file", "digest").distinct(), ["file", "digest"], "left_anti")


def deliver(spark: SparkSession, table: str, hook: Callable[[Row], None]) -> tuple[int, int]:
    """Call ``hook`` with each undelivered file, by period and id: file, file_name, digest, bytes, modified, year, month_num, rows. Returns how many
    calls went through and how many failed.

    An error is logged and does not keep other files back. Deliveries are recorded after every ``RECORDED_AT_ONCE``: a call that is cut off may be
    repeated, with the same file and digest. A file that changes again before it was delivered is handed over once, as it is now.
    """
    order = [*PERIOD, "file"]
    pending = write_shared(undelivered(spark, table).drop("load", "seq"), "outbox").orderBy(*order)
    taken: list[tuple[str, str]] = []
    delivered = failed = 0

    def record() -> None:
        if taken:
            rows = spark.createDataFrame(taken, "file STRING, digest STRING").withColumn("delivered", F.current_timestamp())
            rows.coalesce(1).write.mode("append").parquet(f"{table.rstrip('/')}/_delivered")
            taken.clear()

    try:
        for row in pending.toLocalIterator():
            try:
                hook(row)
            except Exception:  # the next call tries again
                failed += 1
                LOG.exception("the hook failed on %s", row.file)
                continue
            delivered += 1
            taken.append((row.file, row.digest))
            if len(taken) >= RECORDED_AT_ONCE:
                record()
    finally:
        record()
    return delivered, failed
