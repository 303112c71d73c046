"""Near-duplicate texts by the distance of their SimHash fingerprints, found with an index of byte positions.

Two fingerprints that differ in at most ``bits`` bits differ in at most as many bytes, so at least ``8 - bits`` of their eight
positional bytes are equal. The index posts every distinct fingerprint under several of its positional bytes at once: the eight
positions form ``bits + 2`` groups, of which any linked pair shares two, and each pair of groups is a posting. (A list under one byte alone
would hold a 256th of the corpus.) In each list the shared positional bytes of every pair are tallied; pairs that reach the
guaranteed minimum are verified bit by bit.

Lists of more than ``longest`` members are not expanded into pairs. Their members share the bytes of the posting and
post anew under further positional bytes, up to the guaranteed minimum; what is left of the fingerprint then differs by ``bits`` at most exactly if two
members have a common neighbour in half that distance, so members meet under their neighbours, and one link to the smallest of them joins them all. Both
ways are exact, and the rows made are linear in a list's members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stationhour.llm.jaccard_join import components
from stationhour.session import write_shared

POSITIONS = 8
_COUNTED_AT_ONCE = 1 << 16  # shingle hashes that are spread into bits at a time


def fingerprint(text: str | None, words: int) -> int:
    """Majority of the bits of the text's shingle hashes, as an unsigned number; 0 without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII spaces only
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    end = np.cumsum([len(w) + 1 for w in found]) - 1
    start = np.append(0, end[:-words] + 1)
    stop = end[words - 1:]
    ones, total = np.zeros(64, np.int64), len(start)
    for first in range(0, total, _COUNTED_AT_ONCE):
        part = slice(first, first + _COUNTED_AT_ONCE)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(start[part].tolist(), stop[part].tolist(), strict=True)]
        spread = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += spread.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, print): the fingerprint of every row as a signed long."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view("<i8"), pa.int64())], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(mark, "doc_id long, print long")


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(0xFF))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _mask(positions: tuple[int, ...]) -> int:
    """All bits of the bytes at these positions."""
    return _signed(sum(0xFF << 8 * p for p in positions))


def position_groups(bits: int) -> list[tuple[int, ...]]:
    """The eight positions in ``bits + 2`` groups of about equal size."""
    groups = bits + 2
    return [tuple(range(POSITIONS * g // groups, POSITIONS * (g + 1) // groups)) for g in range(groups)]


def postings(bits: int) -> list[tuple[int, ...]]:
    """The positions of each posting: a pair of groups. ``bits`` flips leave two groups untouched at least."""
    return [a + b for a, b in combinations(position_groups(bits), 2)]


def shared_bytes(a: Column, b: Column) -> Column:
    """Positional bytes in which two fingerprints are equal."""
    return reduce(add, [(_byte(a, p) == _byte(b, p)).cast("int") for p in range(POSITIONS)])


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _posted(prints: DataFrame, keys: list[tuple[int, ...]]) -> DataFrame:
    posts = F.array(*[F.struct(F.lit(i).alias("posting"), F.col("print").bitwiseAND(F.lit(_mask(k))).alias("value")) for i, k in enumerate(keys)])
    return prints.select("print", F.explode(posts).alias("p")).select("print", "p.posting", "p.value")


def _short_links(members: DataFrame, bits: int) -> DataFrame:
    """Tally the shared bytes of the pairs in each list, keep those that reach the minimum, verify."""
    a, b = members.alias("a"), members.alias("b")
    x, y = F.col("a.print"), F.col("b.print")
    pairs = a.join(b, (F.col("a.posting") == F.col("b.posting")) & (F.col("a.value") == F.col("b.value")) & (x < y))
    tallied = pairs.select(x.alias("src"), y.alias("dst"), shared_bytes(x, y).alias("shared")).filter(F.col("shared") >= POSITIONS - bits)
    return tallied.filter(differing_bits(F.col("src"), F.col("dst")) <= bits).select("src", "dst").distinct()


def _long_links(members: DataFrame, keys: list[tuple[int, ...]], bits: int) -> DataFrame:
    """A link from each member of a long list to the smallest fingerprint that it shares a neighbour with, of each neighbour."""
    near = [c for n in range(bits // 2 + 1) for c in combinations(range(8 * POSITIONS), n)]
    flips = F.array(*[F.lit(_signed(sum(1 << b for b in c))) for c in near])

    def masks_left(key: tuple[int, ...]) -> Column:
        """Masks of the positions that are left when further ones complete the posting to the minimum."""
        rest = [p for p in range(POSITIONS) if p not in key]
        return F.array(*[F.lit(_mask(tuple(p for p in rest if p not in more))) for more in combinations(rest, POSITIONS - bits - len(key))])

    finer = members.select("print", F.explode(F.element_at(F.array(*map(masks_left, keys)), F.col("posting") + 1)).alias("left"))
    within = F.filter(flips, lambda flip: flip.bitwiseAND(F.bitwise_not("left")) == 0)
    rows = finer.distinct().select("print", "left", F.explode(within).alias("flip")).select("print", "left", F.col("print").bitwiseXOR(F.col("flip")).alias("neighbour"))
    least = rows.groupBy("left", "neighbour").agg(F.min("print").alias("dst"), F.count(F.lit(1)).alias("met")).filter("met > 1")
    return rows.join(least, ["left", "neighbour"]).filter("print <> dst").select(F.col("print").alias("src"), "dst").distinct()


def links(prints: DataFrame, bits: int = 2, longest: int = 64) -> DataFrame:
    """(src, dst) pairs of distinct fingerprints at ``bits`` differing bits or fewer: enough of them to join all that are linked."""
    if bits not in (2, 4):
        raise ValueError("bits is 2 or 4")
    keys = postings(bits)
    posted = write_shared(_posted(prints, keys), "simhash_postings")
    lists = posted.groupBy("posting", "value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = write_shared(posted.join(lists, ["posting", "value"]), "simhash_lists")
    short = _short_links(members.filter(F.col("members") <= longest), bits)
    long = _long_links(members.filter(F.col("members") > longest).select("print", "posting"), keys, bits)
    return short.unionByName(long)


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, text: str = "text", longest: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links, its own included).

    A-Z are lower-cased; a shingle is ``words`` consecutive words joined by a space, repeats included, with fewer words the whole sequence. A bit of
    the fingerprint is set if more than half of the shingles' XXH64 (seed 42) have it. Null, empty and wordless texts have fingerprint 0 and link like
    others. Rows with equal fingerprints are linked, repeated rows too. Rows without an id take part; where a component has no id, component_id is
    null. Only doc_id and the text are read, so names of other columns cannot clash. An empty table gives no rows.
    """
    marked = write_shared(fingerprints(docs, words, text), "simhash_prints")
    classes = write_shared(marked.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash_classes")
    label = components(links(classes.select("print"), bits, longest), "simhash_components")
    named = classes.join(label.select(F.col("cls").alias("print"), "component"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "component").select("print", "component_id")
    return (marked.join(found, "print")
            .select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"))
