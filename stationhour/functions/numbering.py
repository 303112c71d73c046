"""Row numbers over a total order without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationhour.session import write_shared


def number_rows(df: DataFrame, order: list[str], column: str = "row_number") -> DataFrame:
    """Add 0-based positions in ``order``.

    Rows are range-partitioned and sorted by ``order`` and written once with their slice and their place in it:
    slice bounds come from sampling, so both uses below must see the same slices. The slice sizes (one row per
    slice) give each slice its offset. The row id counts up from the slice number times 2**33.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    sliced = write_shared(placed, "ordered-slices")
    before = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
               .select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return (sliced.join(F.broadcast(offsets), "slice")
            .withColumn(column, F.col("offset") + F.col("place"))
            .drop("slice", "place", "offset"))
