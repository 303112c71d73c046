"""Two-pass external shuffle of a corpus into shards, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationhour.llm.staging import free_name
from stationhour.session import shared_path


MOST_TASKS = 100_000


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """Rendezvous hashing: the shard whose hash with the key is largest. The key and the number of shards
    decide; with one shard more, rows only ever move to the new one."""
    weights = F.array(*[F.xxhash64(key, F.lit(s), F.lit(seed)) for s in range(shards)])
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shuffle_into_shards(docs: DataFrame, shards: int = 24, seed: int = 17, bucket_bytes: int = 12 << 20,
                        path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Deal ``docs`` into shards and order every shard at random; the shards are written to ``path``.

    First pass: rows are scattered by seeded hashes over buckets of about ``bucket_bytes``, several a shard (the hash takes
    in the row's place, so equal keys or null keys spread too). Second pass: each bucket, which
    fits in memory, gets a Fisher-Yates shuffle (``F.shuffle``) and is written. The written table alone is read afterwards:
    the order is drawn once, whatever is lost later. The seed fixes a key's shard; the order also depends on how the rows were dealt
    to tasks, so it is the written table, not the seed, that repeats it. Columns may have any type, maps included.

    Returns the columns of ``docs`` with shard (int), slot (long, gapless from 0 in its shard) and grown_shard
    (int, with one shard more). Input columns of these names are replaced. Null texts count 8 bytes; null keys
    are a key of their own; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {"shard", "slot", "grown_shard"}])
    total = docs.agg(F.sum(record_bytes(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    bucket, place, record, row = (free_name(docs.columns, x) for x in ("bucket", "place", "record", "row"))
    scattered = (docs.withColumn(row, F.monotonically_increasing_id())
                 .withColumn("shard", shard_of(F.col(key), shards, seed))
                 .withColumn("grown_shard", shard_of(F.col(key), shards + 1, seed))
                 .withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed + 1), key, row), F.lit(buckets)).cast("int")))
    entry = F.struct(F.xxhash64(F.lit(seed + 2), key, row).alias("h"), F.col(row).alias("r"),
                     F.struct(*docs.columns, "grown_shard").alias("v"))
    def before(a: Column, b: Column) -> Column:  # by hash and row alone: records may hold what has no order
        less = (a["h"] < b["h"]) | ((a["h"] == b["h"]) & (a["r"] < b["r"]))
        return F.when(less, -1).when((a["h"] == b["h"]) & (a["r"] == b["r"]), 0).otherwise(1)

    # a task holds about one bucket
    dealt = scattered.repartition(min(shards * buckets, MOST_TASKS), "shard", bucket)
    shuffled = (dealt.groupBy("shard", bucket).agg(F.shuffle(F.array_sort(F.collect_list(entry), before), seed).alias(record))
                .select("shard", bucket, F.posexplode(record).alias(place, record))
                .select("shard", bucket, place, f"{record}.v.*"))
    path = path or shared_path(spark, "shards")
    shuffled.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    written = spark.read.schema(shuffled.schema).parquet(path)
    earlier = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (written.groupBy("shard", bucket).agg(F.count(F.lit(1)).alias("n"))
               .select("shard", bucket, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))
    if shards * buckets <= 1_000_000:  # a row for each bucket; beyond that the planner joins as it sees fit
        offsets = F.broadcast(offsets)
    return (written.join(offsets, ["shard", bucket])
            .select(*docs.columns, "shard", (F.col("base") + F.col(place)).alias("slot"), "grown_shard"))
