"""Summaries as mergeable states.

A state is what a group's rows of one file come to: the row count and, for each measure, count, sum, sum of squared deviations and the
sorted values. States of several files merge into the summary of all their rows, so a new or corrected file needs its own rows and the
other files' states, which are smaller, but not the other files' rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationhour.functions.quantiles import refined_quantiles
from stationhour.operators.summary import GROUP_KEYS, INPUT_COLUMNS, finished
from stationhour.functions.scalar import nan_to_null
from stationhour.schemas import CLEAN_TYPES, MEASURES, Params

SLICES = 64  # parts of a group's state where groups outgrow a task


def _fields(suffix: str) -> list[str]:
    return [f"{suffix}_{x}" for x in ("n", "sum", "m2", "values")]


_TYPES = {f.name: f for f in CLEAN_TYPES}
STATE_SCHEMA = T.StructType(
    [_TYPES[k] for k in GROUP_KEYS] + [T.StructField("file", T.StringType()), T.StructField("rows", T.LongType())]
    + [T.StructField(name, kind) for suffix in MEASURES.values()
       for name, kind in zip(_fields(suffix), (T.LongType(), T.DoubleType(), T.DoubleType(), T.ArrayType(T.DoubleType())), strict=True)])


def file_states(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """One state per group and file of cleaned rows that carry ``file``, in one shuffle. Rows with a null key drop out, NaN counts as null.

    With ``params.medians = "split"`` a group's state comes in up to ``SLICES`` rows, dealt by its values.
    """
    rows = nan_to_null(rows.select(*INPUT_COLUMNS, "file").dropna(subset=GROUP_KEYS))
    by = [*GROUP_KEYS, "file"]
    if params.medians == "split":
        rows, by = rows.withColumn("slice", F.pmod(F.xxhash64(*MEASURES), F.lit(SLICES))), [*by, "slice"]
    states = [F.count(F.lit(1)).alias("rows")]
    for column, suffix in MEASURES.items():
        n, total, m2, values = _fields(suffix)
        states += [F.count(column).alias(n), F.sum(column).alias(total),
                   (F.var_pop(column) * F.count(column)).alias(m2), F.sort_array(F.collect_list(column)).alias(values)]
    return rows.groupBy(*by).agg(*states).select(*STATE_SCHEMA.names)


def _merged_m2(suffix: str) -> Column:
    """Sum of squared deviations of all states of a group, merged pair by pair."""
    n, total, m2, _ = _fields(suffix)
    parts = f"collect_list(CASE WHEN {n} > 0 THEN struct(CAST({n} AS DOUBLE) AS n, {total} AS s, {m2} AS m2) END)"
    apart = "(b.s / b.n - a.s / a.n)"
    merged = f"struct(a.n + b.n AS n, a.s + b.s AS s, a.m2 + b.m2 + {apart} * {apart} * (a.n * b.n / (a.n + b.n)) AS m2)"
    return F.expr(f"aggregate(slice({parts}, 2, 1000000000), get({parts}, 0), (a, b) -> {merged}).m2")


def merge_states(states: DataFrame, keys: Sequence[str] = GROUP_KEYS, values: bool = True) -> DataFrame:
    """One state per group from those of any number of files, without the sorted values if they are not asked for."""
    merged = [F.sum("rows").alias("rows")]
    for suffix in MEASURES.values():
        n, total, m2, own = _fields(suffix)
        merged += [F.sum(n).alias(n), F.sum(total).alias(total), _merged_m2(suffix).alias(m2)]
        if values:
            merged.append(F.sort_array(F.flatten(F.collect_list(own))).alias(own))
    return states.groupBy(*keys).agg(*merged)


def _middle(values: str) -> Column:
    at = lambda place: f"get({values}, CAST({place} AS INT))"
    return F.expr(f"CASE WHEN size({values}) > 0 THEN ({at(f'(size({values}) - 1) DIV 2')} + {at(f'size({values}) DIV 2')}) / 2 END")


def summary_of_states(states: DataFrame, params: Params = Params()) -> DataFrame:
    """The station-hour summary of all rows behind the states; equals the summary of the rows themselves."""
    split = params.medians == "split"
    merged = merge_states(states, values=not split)
    columns = {"days_observed": F.col("rows")}
    for suffix in MEASURES.values():
        n, total, m2, values = _fields(suffix)
        columns[f"avg_{suffix}"] = F.when(F.col(n) > 0, F.col(total) / F.col(n))
        columns[f"sd_{suffix}"] = F.when(F.col(n) > 1, F.sqrt(F.col(m2) / (F.col(n) - 1)))
        if not split:
            columns[f"median_{suffix}"] = _middle(values)
    summary = merged.withColumns(columns)
    if split:
        pairs = F.array(*[F.struct(F.lit(s).alias("measure"), F.col(f"{s}_values").alias("values")) for s in MEASURES.values()])
        counts = (states.select(*GROUP_KEYS, F.explode(pairs).alias("p")).select(*GROUP_KEYS, "p.measure", F.explode("p.values").alias("value"))
                  .groupBy(*GROUP_KEYS, "measure", "value").agg(F.count(F.lit(1)).alias("n")))
        medians = refined_quantiles(counts, GROUP_KEYS, {f"median_{s}": (s, 0.5) for s in MEASURES.values()})
        summary = summary.join(medians, GROUP_KEYS, "left")
    return finished(summary, params)
