"""Exact grouped quantiles whose work is spread even when one group holds most rows.

The built-in percentile keeps every distinct value of a group in one buffer. Here the values are
counted first (a shuffle by group and value, combined before it), the counts are summed per group
and value bucket, and only the buckets that hold a wanted rank are ordered. A bucket is a fixed
slice of the value axis, so the same row falls into the same bucket in every evaluation.
Where values may crowd in one bucket, :func:`refined_quantiles` narrows it step by step instead of ordering it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationhour.session import write_shared

BUCKETS_PER_DOUBLING = 1024


def value_bucket(value: Column) -> Column:
    """Monotone bucket number: linear-logarithmic slices, about 0.07 % wide for |value| > 1."""
    size = F.floor(F.log2(F.abs(value) + 1.0) * BUCKETS_PER_DOUBLING)
    return F.when(value < 0, -size - 1).otherwise(size).cast("int")


def value_counts(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """(keys, measure, value, n): how often each non-null value of each measure occurs."""
    pairs = F.array(*[F.struct(F.lit(name).alias("measure"), value.cast("double").alias("value"))
                      for name, value in measures.items()])
    return (df.select(*keys, F.explode(pairs).alias("pair"))
            .select(*keys, "pair.measure", "pair.value")
            .where(F.col("value").isNotNull() & ~F.isnan("value"))
            .groupBy(*keys, "measure", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str],
                        quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """Interpolated quantiles from :func:`value_counts`; one column per (measure, fraction)."""
    group = [*keys, "measure"]
    bucketed = counts.withColumn("bucket", value_bucket(F.col("value")))
    # the join below implies these filters for one side; stated here, both sides share one exchange
    for column in [*group, "bucket"]:
        bucketed = bucketed.where(F.col(column).isNotNull())
    sizes = bucketed.groupBy(*group, "bucket").agg(F.sum("n").alias("bucket_n"))

    # at most a few ten thousand buckets per group, whatever its number of rows
    before = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    placed = sizes.select(
        *group, "bucket", "bucket_n",
        F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("start"),
        F.sum("bucket_n").over(whole).alias("total"))

    wanted = [(name, measure, fraction) for name, (measure, fraction) in quantiles.items()]
    asked = F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(measure).alias("of"),
                               F.lit(float(fraction)).alias("fraction")) for name, measure, fraction in wanted])
    position = F.col("ask.fraction") * (F.col("total") - 1)
    last = F.col("start") + F.col("bucket_n")
    targets = (placed.withColumn("ask", F.explode(asked)).where("measure = ask.of")
               .withColumn("low_rank", F.floor(position)).withColumn("high_rank", F.ceil(position))
               .withColumn("weight", position - F.col("low_rank"))
               .where(((F.col("low_rank") >= F.col("start")) & (F.col("low_rank") < last))
                      | ((F.col("high_rank") >= F.col("start")) & (F.col("high_rank") < last)))
               .groupBy(*group, "bucket", "start")
               .agg(F.collect_list(F.struct("ask.quantile", "low_rank", "high_rank", "weight")).alias("asks")))

    inside = W.partitionBy(*group, "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = (bucketed.join(targets, [*group, "bucket"])
              .withColumn("last", F.col("start") + F.sum("n").over(inside))
              .withColumn("first", F.col("last") - F.col("n")))
    covers = lambda rank: (F.col(rank) >= F.col("first")) & (F.col(rank) < F.col("last"))
    picked = (ranked.select(*keys, "value", "first", "last", F.explode("asks").alias("a"))
              .select(*keys, "value", "first", "last", "a.*")
              .where(covers("low_rank") | covers("high_rank")))
    return (picked.groupBy(*keys).agg(*[
        _interpolate(name, covers).alias(name) for name in quantiles]))


def _interpolate(name: str, covers) -> Column:
    mine = F.col("quantile") == name
    low = F.max(F.when(mine & covers("low_rank"), F.col("value")))
    high = F.max(F.when(mine & covers("high_rank"), F.col("value")))
    weight = F.max(F.when(mine, F.col("weight")))
    return F.when(low == high, low).otherwise(low * (1 - weight) + high * weight)


def grouped_quantiles(df: DataFrame, keys: Sequence[str], measures: dict[str, Column],
                      quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact quantiles per group, e.g. ``quantiles={"median_flow": ("flow", 0.5)}``.

    Groups with a null key, or without a non-null value in any measure, have no row.
    """
    return quantiles_of_counts(value_counts(df, keys, measures), keys, quantiles)


def grouped_medians(df: DataFrame, keys: Sequence[str], medians: dict[str, Column], refine: bool = False) -> DataFrame:
    of = refined_quantiles if refine else quantiles_of_counts
    return of(value_counts(df, keys, medians), keys, {name: (name, 0.5) for name in medians})


def refined_quantiles(counts: DataFrame, keys: Sequence[str], quantiles: dict[str, tuple[str, float]], *, buckets: int = 1024,
                      bound: int = 4096) -> DataFrame:
    """The same as :func:`quantiles_of_counts` for values that may crowd anywhere: no task ever orders more than ``bound`` values of a group.

    For each wanted rank the value range that holds it is cut into ``buckets`` slices; what is counted in them says which slice has the rank, and that slice's own smallest and
    largest value are the next range. This is repeated, a job each time, until the rank is at the edge of a slice or the slice has no more than
    ``bound`` distinct values. Ranges and ranks, a few a group, are written after each step.
    """
    group = [*keys, "measure"]
    for column in group:
        counts = counts.where(F.col(column).isNotNull())
    counts = write_shared(counts.where(F.col("value").isNotNull()), "value-counts")
    wanted = [(name, measure, float(fraction)) for name, (measure, fraction) in quantiles.items()]
    asked = F.array(*[F.struct(F.lit(name).alias("quantile"), F.lit(measure).alias("of"), F.lit(f).alias("fraction")) for name, measure, f in wanted])
    totals = counts.groupBy(*group).agg(F.sum("n").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"))
    position = F.col("ask.fraction") * (F.col("total") - 1)
    ranks = (totals.withColumn("ask", F.explode(asked)).where("measure = ask.of")
             .select(*group, F.col("ask.quantile").alias("quantile"), "low", "high", (position - F.floor(position)).alias("weight"),
                     F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank")))
    # below: values counted in front of the range; found: the value once it is known
    step = write_shared(ranks.withColumns({"below": F.lit(0).cast("long"), "distinct": F.lit(None).cast("long"), "found": F.when(F.col("low") == F.col("high"), F.col("low"))}),
                        "quantile-ranks")
    ask = [*group, "rank"]
    before = W.partitionBy(*ask).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    while not (wide := step.where(f"found IS NULL AND (distinct IS NULL OR distinct > {bound})")).isEmpty():
        ranges = wide.select(*ask, "low", "high", "below").distinct()
        slice_of = F.least(F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * buckets), F.lit(buckets - 1)).cast("int")
        slices = (counts.join(ranges, group).where("value BETWEEN low AND high").groupBy(*ask, "below", slice_of.alias("bucket"))
                  .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"), F.min("value").alias("least"), F.max("value").alias("most")))
        start = F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0))
        holds = slices.withColumn("start", start).where("rank >= start AND rank < start + n")
        first, last = F.col("rank") == F.col("start"), F.col("rank") == F.col("start") + F.col("n") - 1
        value = F.when(first | (F.col("d") == 1), F.col("least")).when(last, F.col("most"))
        narrowed = holds.select(*ask, "least", "most", "start", "d", value.alias("value"))
        changed = F.col("start").isNotNull()
        step = write_shared(step.join(narrowed, ask, "left").select(
            *group, "quantile", F.when(changed, F.col("least")).otherwise(F.col("low")).alias("low"), F.when(changed, F.col("most")).otherwise(F.col("high")).alias("high"),
            "weight", "rank", F.when(changed, F.col("start")).otherwise(F.col("below")).alias("below"), F.coalesce("d", "distinct").alias("distinct"),
            F.coalesce("value", "found").alias("found")), "quantile-ranks")
    open_ranges = step.where("found IS NULL").select(*ask, "low", "high", "below").distinct()
    inside = W.partitionBy(*ask).orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ordered = (counts.join(open_ranges, group).where("value BETWEEN low AND high").withColumn("last", F.col("below") + F.sum("n").over(inside))
               .where("rank >= last - n AND rank < last").select(*ask, F.col("value").alias("ordered")))
    known = step.join(ordered, ask, "left").withColumn("found", F.coalesce("found", "ordered"))
    ends = known.groupBy(*group, "quantile").agg(F.min_by("found", "rank").alias("a"), F.max_by("found", "rank").alias("b"), F.first("weight").alias("w"))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * (1 - F.col("w")) + F.col("b") * F.col("w"))
    return ends.groupBy(*keys).agg(*[F.max(F.when(F.col("quantile") == name, value)).alias(name) for name in quantiles])
