"""Windowed measures of an event stream.

The stream counts values per window, so its state is one small row per (window, key, value),
spread over the state partitions even if one window or key is hot. Means and exact medians follow
from the counts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationhour.functions.quantiles import quantiles_of_counts, refined_quantiles
from stationhour.sources.versions import Folder

WINDOW = ["window_start", "window_end"]


def windowed_value_counts(events: DataFrame, time: str, keys: Sequence[str], value: str,
                          window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """(window, keys, value, n) on a stream; rows later than the watermark drop. Append it to a table to get each window once it has
    closed, or pass it to ``upsert_counts`` to see open ones too."""
    # watermarks need a zoned type; windows are cut in the session's zone
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    counted = timed.groupBy(F.window(time, window), *keys, F.col(value).cast("double").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          *keys, "value", "n")


MERGE_AFTER = 16  # micro-batches after which their updates are put together


def _parts(folder: Folder) -> list[str]:
    """The folders that make up the table: those that the last batch published."""
    names = [n for n in folder.names("_batches") if n.endswith(".json")]
    return json.loads(folder.read("_batches", names[-1])) if names else []


def current_counts(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Counts of all windows, open and closed, as of the last micro-batch. Counts only grow, so the largest of a (window, keys, value) is the last."""
    parts = _parts(Folder(spark, table))
    if not parts:
        return spark.createDataFrame([], schema)
    updates = spark.read.schema(schema).parquet(*[f"{table.rstrip('/')}/_data/{p}" for p in parts])
    return updates.groupBy(*[c for c in schema.names if c != "n"]).agg(F.max("n").alias("n"))


def upsert_counts(counts: DataFrame, table: str, checkpoint: str, merge_after: int = MERGE_AFTER) -> None:
    """Keep a table of windowed counts up to date, windows that are still open included; no earlier event is read again.

    The stream runs in update mode: a micro-batch brings the counts that it changed, from the stream's state, which holds open windows only. They
    are written as a part of the table, and a list of parts is published under the batch's number: readers see whole batches, and a replayed batch
    finds its number taken and changes nothing. After ``merge_after`` parts they are merged into one. Rows later than the watermark are dropped by the stream.
    """
    schema = counts.schema

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder, part = Folder(spark, table), f"batch={batch_id}"
        if f"{batch_id:012d}.json" in folder.names("_batches"):
            return
        batch.write.mode("overwrite").parquet(f"{folder.root}/_data/{part}")
        parts = [*_parts(folder), part]
        if len(parts) > merge_after:
            every = spark.read.schema(schema).parquet(*[f"{folder.root}/_data/{p}" for p in parts])
            merged = every.groupBy(*[c for c in schema.names if c != "n"]).agg(F.max("n").alias("n"))
            merged.select(*schema.names).write.mode("overwrite").parquet(f"{folder.root}/_data/merged={batch_id}")
            parts = [f"merged={batch_id}"]
        folder.create(json.dumps(parts), "_batches", f"{batch_id:012d}.json")

    (counts.writeStream.foreachBatch(process).outputMode("update").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def window_summary(counts: DataFrame, keys: Sequence[str], refine: bool = False) -> DataFrame:
    """Row count, mean and exact median per window and key from counts. ``refine`` narrows value ranges step by step (see
    ``refined_quantiles``), for windows with millions of values that lie close together."""
    group = [*WINDOW, *keys]
    known = F.col("value").isNotNull()
    totals = counts.groupBy(*group).agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("value") * F.col("n")) / F.sum(F.when(known, F.col("n")))).alias("mean_value"))
    of = refined_quantiles if refine else quantiles_of_counts
    medians = of(counts.where(known).withColumn("measure", F.lit("value")), group,
                                  {"median_value": ("value", 0.5)})
    return totals.join(medians, group, "left")
