"""Merkle tree over the rows of a dataset, by window functions.

Rows have gapless positions in their group. A run of ``fanout`` consecutive nodes has one parent; a window over a block of
``fanout ** LEVELS`` leaves holds all nodes of that many levels, each on the row of its first leaf. Per level, lag and lead columns
at fixed offsets, masked by the node's slot and the length of its run, are the siblings, and rows of first children hash the
parents. Blocks are the leaves of the next round, so a window never sees more than one block, however large a group is.
On the way down each block hands the rest of the path to its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationhour.functions.numbering import number_rows
from stationhour.session import write_shared

LEVELS = 4  # a window holds fanout ** LEVELS rows
_STEP = "struct<left: string, right: string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """Byte count, colon and value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(F.concat(*map(encoded, values)))


def _whole(n: Column, step: int) -> Column:
    return F.call_function("div", n, F.lit(step))


def _nodes_at(n: Column, step: int) -> Column:
    return _whole(n + (step - 1), step)


def _climb(nodes: DataFrame, fanout: int) -> DataFrame:
    """Add path (a step for each level that the group has within a block) and top, the block's node, on its first row."""
    size = fanout ** LEVELS
    at, n = F.col("at"), F.col("n")
    block = Window.partitionBy("group", "block").orderBy("at")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    rows = nodes.withColumns({"block": _whole(at, size), "top": F.col("digest")})
    steps = []
    for level in range(LEVELS):
        step = fanout ** level
        number, many = _whole(at, step), _nodes_at(n, step)
        slot = number % fanout
        run = F.least(F.lit(fanout), many - (number - slot))
        node, left, right = F.col("top"), f"left_{level}", f"right_{level}"
        before = [F.when(slot >= j, F.lag("top", j * step).over(block)) for j in range(fanout - 1, 0, -1)]
        after = [F.when(slot + j < run, F.lead("top", j * step).over(block)) for j in range(1, fanout)]
        rows = rows.withColumns({name: F.when(node.isNotNull(), F.concat(*[F.coalesce(x, F.lit("")) for x in siblings]))
                                 for name, siblings in ((left, before), (right, after))})
        parent = F.when(many > 1, digest(F.concat(node, F.col(right)))).otherwise(node)
        rows = rows.withColumn("top", F.when(at % (step * fanout) == 0, parent))
        # rows of one subtree share its siblings
        shared = [F.last(x, ignorenulls=True).over(so_far).alias(y) for x, y in ((left, "left"), (right, "right"))]
        steps.append((F.struct(*shared), many > 1))
    rows = rows.withColumns({f"step_{i}": s for i, (s, _) in enumerate(steps)})
    path = F.array(*[F.when(more, F.col(f"step_{i}")) for i, (_, more) in enumerate(steps)])
    return rows.select(*nodes.columns, "block", "top", F.filter(path, lambda x: x.isNotNull()).alias("path"))


def _ascend(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes, then the blocks of each round up to the one node of each group; all but the first are written."""
    size, levels = fanout ** LEVELS, [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        up = _climb(levels[-1].select("group", "at", "n", "digest"), fanout).filter(F.col("at") % size == 0)
        levels.append(write_shared(up.select("group", F.col("block").alias("at"), _nodes_at(F.col("n"), size).alias("n"), F.col("top").alias("digest")),
                                   "merkle_nodes"))
        largest = -(-largest // size)
        if largest <= 1:
            return levels


def _descend(levels: list[DataFrame], top: DataFrame, fanout: int) -> DataFrame:
    """The rows of ``levels[0]`` with their whole path and the columns of ``top`` (group, at, path and others)."""
    above, others = top, [c for c in top.columns if c not in ("group", "at", "path")]
    for nodes in reversed(levels[:-1]):
        parent = above.select(F.col("group").alias("of"), F.col("at").alias("above"), F.col("path").alias("rest"), *others)
        rows = _climb(nodes, fanout)
        joined = rows.join(parent, (F.col("group") == F.col("of")) & (F.col("block") == F.col("above")))
        above = joined.select(*nodes.columns, F.concat("path", "rest").alias("path"), *others)
    return above


def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with at (position in its group, from 0) and n (rows of the group). ``order`` starts with group."""
    numbered = number_rows(rows, order, "number")
    groups = write_shared(numbered.groupBy("group").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n")), "merkle_groups")
    return numbered.join(groups, "group").withColumn("at", F.col("number") - F.col("first")).drop("number", "first")


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", key: str = "doc_id",
             fanout: int = 8, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """A row for each row of ``docs``: ``key``, ``group``, leaf, subroot, root, path and the columns of ``carry`` (further expressions over ``docs``).

    A leaf hashes the ``fields`` (strings or integers) in their order. In each group, null being one, leaves ascend by key (null first; rows
    with equal keys by leaf); while there are several nodes, every ``fanout`` consecutive ones become their digest, of the last run also fewer, even
    one. The node left is the subroot; subroots, ordered by group (null first, else by UTF-8 bytes), give the root in the same way. ``path``
    has a (left, right) pair for each level up to the root: the digests of the run's other nodes before and after, concatenated.

    Digests are lowercase hex. Repeated rows are leaves of their own; empty texts differ from null ones; texts are hashed whole where they are read, only
    digests move. Other columns of ``docs`` are not read, so their names cannot clash. An empty table gives no rows.
    """
    carry = dict(carry or {})
    name = F.col(group).cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("group"),  # null first: "-" sorts before "="
                       F.col(key).alias("key"), leaf_digest([F.col(f) for f in fields]).alias("digest"), F.col(group).alias("group_value"),
                       F.struct(F.lit(1).alias("_"), *[c.alias(x) for x, c in carry.items()]).alias("carried"))
    # the range exchange reads its input twice, so the digests are written first; equal rows are told apart to spread them
    rows = write_shared(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle_leaves")
    leaves = write_shared(_positions(rows, ["group", "key", "digest", "tie"]).drop("tie"), "merkle_positions")
    levels = _ascend(leaves, fanout)

    whole = F.lit("").alias("group")
    subroots = _positions(levels[-1].select(whole, F.col("group").alias("name"), "digest"), ["group", "name"])
    upper = _ascend(write_shared(subroots, "merkle_subroots"), fanout)
    none = F.array().cast(f"array<{_STEP}>").alias("path")
    tops = _descend(upper, upper[-1].select("group", "at", none, F.col("digest").alias("root")), fanout)
    tops = write_shared(tops.select(F.col("name").alias("group"), F.lit(0).cast("long").alias("at"), "path", F.col("digest").alias("subroot"), "root"),
                        "merkle_tops")
    found = _descend(levels, tops, fanout)
    return found.select(F.col("key").alias(key), F.col("group_value").alias(group), F.col("digest").alias("leaf"), "subroot", "root", "path",
                        *[F.col(f"carried.{x}").alias(x) for x in carry])


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, x: digest(F.concat(x["left"], node, x["right"])))
