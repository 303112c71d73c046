"""Documents staged once in the shared folder, in chunks that every later pass finds in place.

A staged table is bucketed by ``chunk``: the rows of a scan task, or an equal part of them where they are too large for
the memory of a task. A chunk is one file; grouping or cogrouping the table by chunk then needs no shuffle of the texts, only of what
is sent to the chunks. As the chunks are read back from storage, a lost executor repeats a
pass over the same chunks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stationhour.session import shared_path


def free_name(columns, wanted: str) -> str:
    """``wanted``, lengthened until it clashes with no column, whatever the case of letters."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


@dataclass(frozen=True)
class Staged:
    table: DataFrame
    chunk: str      # chunk column
    row: str        # unique row number, orders the rows of a chunk
    text: str
    chunks: int

    @property
    def shards(self) -> int:
        """Groups into which hashed values are dealt: as many as chunks, not few on small input."""
        return max(256, self.chunks)


def stage(docs: DataFrame, text: str = "text", chunk_bytes: int = 16 << 20) -> Staged:
    """Write ``docs`` (a scan, so that its tasks are known) in chunks of about ``chunk_bytes`` of text at most."""
    spark = docs.sparkSession
    chunk, row = free_name(docs.columns, "__chunk"), free_name(docs.columns, "__row")
    tasks = max(1, docs.rdd.getNumPartitions())
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-total // (tasks * chunk_bytes)))
    chunks = tasks * parts
    # beyond Spark's limit a bucket holds several chunks, which are grouped apart all the same
    buckets = min(chunks, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    name = f"staged_{uuid.uuid4().hex}"
    numbered = (docs.withColumn(row, F.monotonically_increasing_id())
                .withColumn(chunk, (F.spark_partition_id() * parts + F.col(row) % parts).cast("int")))
    (numbered.write.option("path", shared_path(spark, "staged")).option("compression", "zstd")
     .bucketBy(buckets, chunk).saveAsTable(name))
    return Staged(spark.table(name), chunk, row, text, chunks)


def order_key(name: str = "doc_id") -> Column:
    """Ids as compared by the operators: a null id comes after every other."""
    return F.coalesce(F.col(name).cast("long"), F.lit((1 << 63) - 1))
