"""Near-duplicate texts by an exact join on the Jaccard similarity of their word shingles.

A size-aware heavy-light join:

* Equal sets are one class, of which one text is compared. Shingle frequencies are counted over the classes (per chunk, then per
  shard) and those of shared shingles sent back. A shingle
  found once in the corpus is in no intersection; a set with too few shared shingles links with nothing and goes no further.
* Small sets enumerate all subsets of their shared shingles that an intersection could be. Two sets that meet
  under a subset share at least that many shingles, so the sizes alone decide.
* Large sets post the rarest shingles of a prefix that any linked partner must meet, and inverted lists of these postings
  are scanned. Each member is first verified against the list's hubs only, the sets of its size bands with fewest shingles of their own. What these links join
  needs no more checks; then members of a list in different components are verified against each other, if their places in the
  list leave room for enough common shingles.
* The boundary between small and large is the one of least cost, from the corpus's numbers of classes of each small size and the mean length of its
  inverted lists. It decides how links are found, not which.

Sets are compared by 64-bit shingle hashes, classes by 128-bit ones.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from stationhour.llm import vectors as V
from stationhour.llm.staging import Staged, order_key, stage
from stationhour.session import write_shared

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any linked partner, at least."""
    return -(-percent * n // 100)


# Costs of the boundary's model, in rows of a shuffle: to post a shingle, and to verify one pair of sets that meet.
POSTING, VERIFY = 2.0, 4.0
# A set has at most so many subsets, else it is large whatever the costs: they are made in a task's memory.
SUBSETS = 1 << 12


def _subsets(n: int, percent: int) -> int:
    return sum(comb(n, s) for s in range(least_overlap(n, percent), n + 1))


def widest_small(percent: int) -> int:
    """The largest size whose subsets a task can make."""
    n = 1
    while _subsets(n + 1, percent) <= SUBSETS:
        n += 1
    return n


def size_boundary(percent: int, sizes: dict[int, int], list_length: float) -> int:
    """The boundary of least cost: sets up to it are small and enumerate subsets, as do the larger sets that could link with them; sets above post the
    shingles of their prefix and scan lists.

    ``sizes`` has the number of classes of each size (up to ``widest_small``), ``list_length`` the mean length of the corpus's inverted lists. Of equal costs the
    smallest boundary.
    """
    widest = widest_small(percent)
    scan = POSTING + VERIFY * list_length
    postings = {n: (n - least_overlap(n, percent) + 1) * scan * c for n, c in sizes.items()}
    subsets = {n: _subsets(n, percent) * c for n, c in sizes.items() if n <= widest}

    def cost(boundary: int) -> float:
        return (sum(c for n, c in subsets.items() if boundary and n <= boundary * 100 // percent)
                + sum(c for n, c in postings.items() if n > boundary))

    return min(range(widest * percent // 100 + 1), key=cost)


def _shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of every document, sorted."""
    data = _LOWER[data]
    start, end, at = V.words(data, bounds)
    tokens = V.Rolling(V.word_hashes(data, start, end))
    count = np.diff(at)
    whole = np.flatnonzero((count > 0) & (count < size))
    first = np.flatnonzero(V.window_starts(at, int(at[-1]), size))
    doc = np.concatenate([np.searchsorted(at, first, "right") - 1, whole])
    value = np.concatenate([tokens.of(first, first + size), tokens.of(at[whole], at[whole + 1])])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))[:len(doc)]
    return doc[new], value[new]


def _sets(table: pa.Table, text: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of the rows' sets, hashes, two set hashes a row) of a chunk."""
    counts, values = [], []
    for a, b, data, bounds in V.slices(table, text):
        doc, value = _shingles(data, bounds, size)
        counts.append(np.bincount(doc, minlength=b - a))
        values.append(value)
    at = np.concatenate([[0], np.cumsum(np.concatenate(counts or [np.empty(0, np.int64)]))]).astype(np.int64)
    value = np.concatenate(values or [np.empty(0, np.uint64)])
    marks = np.empty((table.num_rows, 2), np.uint64)
    for i, salt in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(V.mix(value ^ _U(salt)), dtype=np.uint64)])
        marks[:, i] = V.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64))
    return at, value, marks


def shingle_classes(staged: Staged, size: int) -> DataFrame:
    """(chunk, row, doc_id, cls, n) of every document: its set's 128-bit hash and size."""
    text, chunk, order = staged.text, staged.chunk, staged.row

    def mark(docs: pa.Table) -> pa.Table:
        at, _, marks = _sets(docs, text, size)
        raw = marks.astype("<u8").tobytes()
        return pa.table([docs.column(chunk), docs.column(order), docs.column("doc_id"),
                         pa.array([raw[i:i + 16] for i in range(0, len(raw), 16)], pa.binary()), pa.array(np.diff(at).astype(np.int32))],
                        names=["chunk", "row", "doc_id", "cls", "n"])

    return (staged.table.select(chunk, order, F.col("doc_id").cast("long").alias("doc_id"), text).groupBy(chunk)
            .applyInArrow(mark, "chunk int, row long, doc_id long, cls binary, n int"))


def first_of_classes(classes: DataFrame) -> DataFrame:
    """(chunk, rows): the smallest row of each class with shingles. Only these are compared, their copies follow."""
    first = F.min(F.struct(order_key("doc_id").alias("id"), "row", "chunk")).alias("first")
    return (classes.filter("n > 0").groupBy("cls").agg(first).groupBy(F.col("first.chunk").alias("chunk"))
            .agg(F.collect_list("first.row").alias("rows")))  # as many as a chunk has rows


def _only(docs: pa.Table, order: str, rows: pa.ChunkedArray) -> pa.Table:
    return docs.filter(pc.is_in(docs.column(order), value_set=pc.list_flatten(rows.combine_chunks())))


def _place(value: np.ndarray, shards: int) -> np.ndarray:
    """Shard, and one of 2**24 counters in it."""
    value = V.mix(value ^ _U(0x2545F4914F6CDD1D))
    return ((value >> _U(32)) * _U(shards)) >> _U(32) << _U(24) | (value & _U(0xFFFFFF))


def _three(cells: np.ndarray) -> bytes:
    return np.ascontiguousarray(cells.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _from_three(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(blob, np.uint8).reshape(-1, 3)
    return wide.reshape(-1).view("<u4")


def _by_shard(place: np.ndarray, shards: int) -> np.ndarray:
    return np.searchsorted(place, np.arange(shards + 1, dtype=np.uint64) << _U(24))


def shingle_counts(staged: Staged, first: DataFrame, size: int, shards: int) -> DataFrame:
    """Counters of each chunk over the first texts of classes: cells counted once, other cells with their counts."""
    text, chunk, order = staged.text, staged.chunk, staged.row
    schema = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("once", pa.binary()), ("cells", pa.binary()), ("counts", pa.binary())])

    def count(docs: pa.Table, first: pa.Table) -> pa.Table:
        if not first.num_rows:
            return schema.empty_table()
        number = first.column("chunk")[0].as_py()
        docs = _only(docs, order, first.column("rows"))
        value = _sets(docs, text, size)[1]
        del docs
        cells, counts = np.unique(_place(value, shards), return_counts=True)
        single, counts = counts == 1, counts.astype(np.uint32)
        bounds, rows = _by_shard(cells, shards), []
        for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if b > a:
                own, one = cells[a:b] & _U(0xFFFFFF), single[a:b]
                rows.append((number, s, _three(own[one]), _three(own[~one]), counts[a:b][~one].tobytes()))
        if not rows:
            return schema.empty_table()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return (staged.table.select(chunk, order, text).groupBy(chunk).cogroup(first.groupBy("chunk"))
            .applyInArrow(count, "chunk int, shard int, once binary, cells binary, counts binary"))


def shared_shingles(counts: DataFrame) -> DataFrame:
    """Cells counted twice or more, to every chunk that has them, with a rank of their count (an eighth of an octave). A shard's first row also says how many
    such cells, that is inverted lists, it has, and with how many members."""
    schema = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("cells", pa.binary()), ("ranks", pa.binary()), ("lists", pa.int64()),
                        ("members", pa.int64())])

    def add(table: pa.Table) -> pa.Table:
        rows = [(c, _from_three(o), _from_three(m), np.frombuffer(k, np.uint32)) for c, o, m, k in
                zip(*(table.column(x).to_pylist() for x in ("chunk", "once", "cells", "counts")), strict=True)]
        total = np.zeros(1 << 24, np.uint32)
        for _, once, more, times in rows:  # cells are distinct within each part
            total[once] += 1
            total[more] += times
        shard, out = table.column("shard")[0].as_py(), []
        several = total[total > 1]
        sums = (len(several), int(several.sum(dtype=np.int64)))
        for number, once, more, _ in rows:
            own = np.concatenate([once[total[once] > 1], more])
            if len(own):
                rank = np.minimum(255, 8 * np.log2(total[own])).astype(np.uint8)
                out.append((number, shard, _three(own), rank.tobytes(), *(sums if not out else (None, None))))
        if not out:
            return schema.empty_table()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return counts.groupBy("shard").applyInArrow(add, "chunk int, shard int, cells binary, ranks binary, lists long, members long")


_NODES = "cls binary, n int, shared binary, postings array<long>, subset_keys array<long>, subset_sizes array<int>"


def nodes(staged: Staged, shared: DataFrame, first: DataFrame, size: int, percent: int, boundary: int, shards: int) -> DataFrame:
    """A row for each class that can link at all: its shared shingles, the postings of a large set and the subsets of a small one."""
    text, chunk, order = staged.text, staged.chunk, staged.row
    widest = boundary * 100 // percent
    schema = pa.schema([("cls", pa.binary()), ("n", pa.int32()), ("shared", pa.binary()), ("postings", pa.list_(pa.int64())),
                        ("subset_keys", pa.list_(pa.int64())), ("subset_sizes", pa.list_(pa.int32()))])

    def build(docs: pa.Table, found: pa.Table) -> pa.Table:
        own_rows = found.filter(pc.is_valid(found.column("rows")))
        found = found.filter(pc.is_valid(found.column("cells")))
        if not own_rows.num_rows or not found.num_rows:
            return schema.empty_table()
        docs = _only(docs, order, own_rows.column("rows"))
        at, value, marks = _sets(docs, text, size)
        del docs
        n = np.diff(at)
        place = np.concatenate([(_U(s) << _U(24)) | _from_three(c).astype(np.uint64) for s, c in
                                zip(found.column("shard").to_pylist(), found.column("cells").to_pylist(), strict=True)])
        rank = V.unpack(found.column("ranks").to_pylist(), np.uint8)
        by = np.argsort(place, kind="stable")
        place, rank = place[by], rank[by]
        own = _place(value, shards)
        near = np.minimum(np.searchsorted(place, own), len(place) - 1)
        common = place[near] == own
        many = np.concatenate([[0], np.cumsum(common)])
        many = many[at[1:]] - many[at[:-1]]
        needed = -(-percent * n // 100)
        raw, out = marks.astype("<u8").tobytes(), []
        for i in np.flatnonzero((n > 0) & (many >= needed)).tolist():
            here = slice(at[i], at[i + 1])
            mine = common[here]
            elements, ranks = value[here][mine], rank[near[here][mine]]
            postings = keys = sizes = None
            if n[i] > boundary:  # the unshared shingles come first in the prefix and meet nobody
                prefix = int(n[i] - needed[i] + 1 - (n[i] - many[i]))
                postings = elements[np.lexsort((elements, ranks))][:prefix].astype(np.int64)
            if n[i] <= widest:
                mixed = V.mix(elements ^ _U(0x8EBC6AF09C88C6E3)).tolist()
                keys, sizes = [], []
                for s in range(int(needed[i]), len(mixed) + 1):
                    for part in combinations(mixed, s):
                        k = (sum(part) + s) & 0xFFFFFFFFFFFFFFFF
                        keys.append(k - (1 << 64) if k >> 63 else k)
                        sizes.append(s)
            out.append((raw[16 * i:16 * i + 16], n[i], elements.tobytes(), postings, keys, sizes))
        if not out:
            return schema.empty_table()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    sent = shared.drop("lists", "members").withColumn("rows", F.lit(None).cast("array<long>")).unionByName(first, allowMissingColumns=True)
    return (staged.table.select(chunk, order, text).groupBy(chunk).cogroup(sent.groupBy("chunk")).applyInArrow(build, _NODES))


def _linked(a: Column, b: Column, overlap: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def subset_links(table: DataFrame, percent: int) -> DataFrame:
    """Links of small sets. Under a subset, whoever links with any set links with the smallest, and nobody else does."""
    rows = (table.filter("subset_keys is not null").select("cls", "n", F.explode(F.arrays_zip("subset_keys", "subset_sizes")).alias("z"))
            .select("cls", "n", F.col("z.subset_keys").alias("k"), F.col("z.subset_sizes").alias("s")))
    hubs = (rows.groupBy("k", "s").agg(F.min(F.struct("n", "cls")).alias("hub"), F.count(F.lit(1)).alias("members"))
            .filter("members > 1").select("k", "s", F.col("hub.cls").alias("to"), F.col("hub.n").alias("hub_n")))
    return (rows.join(hubs, ["k", "s"]).filter((F.col("cls") != F.col("to")) & _linked(F.col("n"), F.col("hub_n"), F.col("s"), percent))
            .select(F.col("cls").alias("src"), F.col("to").alias("dst")).distinct())


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) with their set sizes n and m and the size of their intersection."""
    def check(batches):
        for batch in batches:
            both = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
                x.sort()
                both.append(int((x[1:] == x[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), batch.column(5), pa.array(both, pa.int32())],
                                             names=["src", "dst", "n", "m", "overlap"])

    a = sets.select(F.col("cls").alias("src"), F.col("shared").alias("a"), "n")
    b = sets.select(F.col("cls").alias("dst"), F.col("shared").alias("b"), F.col("n").alias("m"))
    return (pairs.select("src", "dst").join(a, "src").join(b, "dst").select("src", "dst", "a", "b", "n", "m")
            .mapInArrow(check, "src binary, dst binary, n int, m int, overlap int"))


def _links(measured: DataFrame, percent: int) -> DataFrame:
    return measured.filter(_linked(F.col("n"), F.col("m"), F.col("overlap"), percent)).select("src", "dst")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(cls, component) of every linked class, by smallest labels and pointer jumping; each round is written."""
    both = write_shared(links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), f"{name}_links")
    label = write_shared(both.groupBy(F.col("src").alias("cls")).agg(F.least(F.min("dst"), F.first("src")).alias("component")), name)
    while True:
        near = (both.join(label.select(F.col("cls").alias("dst"), "component"), "dst")
                .groupBy(F.col("src").alias("cls")).agg(F.min("component").alias("near")))
        jump = label.select(F.col("cls").alias("component"), F.col("component").alias("over"))
        step = (label.join(near, "cls").join(jump, "component", "left")
                .select("cls", F.least("component", "near", "over").alias("component"), F.col("component").alias("old")))
        step = write_shared(step, name)
        label = step.select("cls", "component")
        if step.filter(F.col("component") != F.col("old")).isEmpty():
            return label


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def list_links(table: DataFrame, percent: int, known: DataFrame) -> DataFrame:
    """Links of large sets, enough to join all that are linked. ``known`` has the links found so far."""
    sets = table.filter("postings is not null")
    ratio = float(np.log(100 / percent))
    lists = write_shared(
        sets.select("cls", "n", (F.length("shared") / 8).cast("int").alias("many"), F.posexplode("postings").alias("place", "e"))
        .withColumn("place", F.col("place") + F.col("n") - F.col("many"))  # the set's own shingles stand first
        .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int")), "inverted_lists")

    def close(n: Column, m: Column, common: Column, others: Column) -> Column:
        """Can sets of these sizes and shared shingles link?"""
        least, most = F.least(n, m), F.greatest(n, m)
        return (100 * least >= percent * most) & _linked(n, m, F.least(common, others), percent)

    # of copies of one text, the one with fewest shingles of its own is nearest to the text, and so linked with most others
    own = F.struct((F.col("n") - F.col("many")).alias("own"), "n", "cls", "many")
    hubs = lists.groupBy("e", "band").agg(F.min(own).alias("hub"))
    hubs = hubs.select("e", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("hub.cls").alias("to"),
                       F.col("hub.n").alias("hub_n"), F.col("hub.many").alias("hub_many"))
    first = (lists.join(hubs, ["e", "band"]).filter((F.col("cls") != F.col("to")) & close(F.col("n"), F.col("hub_n"), F.col("many"), F.col("hub_many")))
             .select(*_ordered("cls", "to")).distinct())
    first = write_shared(_overlaps(first, sets), "hub_overlaps")
    found = write_shared(known.unionByName(_links(first, percent)), "hub_links")
    label = components(found)

    # lists that still hold several components: the members outside the list's largest against all its members
    marked = lists.join(label, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    several = marked.groupBy("e").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("e")
    marked = write_shared(marked.join(several, "e", "left_semi"), "mixed_lists")
    largest = (marked.groupBy("e", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("e").agg(F.max(F.struct("c", "component")).alias("top"))
               .select("e", F.col("top.component").alias("major")))
    minor = marked.join(largest, "e").filter(F.col("component") != F.col("major"))
    right = marked.select("e", F.col("cls").alias("to"), F.col("n").alias("m"), F.col("place").alias("its_place"), F.col("component").alias("its"),
                          F.col("band").alias("near"))
    left = minor.withColumn("near", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    # in the list of their first common shingle, what stands before its place in either set is not shared
    left_over = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("its_place"))
    rest = (left.join(right, ["e", "near"]).filter((F.col("component") != F.col("its")) & _linked(F.col("n"), F.col("m"), left_over, percent))
            .select(*_ordered("cls", "to")).distinct().join(first, ["src", "dst"], "left_anti"))
    return found.unionByName(_links(_overlaps(rest, sets), percent))


def _classes(docs: Staged, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a row per document with its class, the component of each linked class)."""
    shards = 4 * docs.shards
    classes = write_shared(shingle_classes(docs, size), "shingle_classes")
    first = write_shared(first_of_classes(classes), "first_of_classes")
    shared = write_shared(shared_shingles(shingle_counts(docs, first, size, shards)), "shared_shingles")
    sums = shared.agg(F.sum("members") / F.sum("lists")).first()
    sizes = classes.filter(f"n between 1 and {widest_small(percent)}").groupBy("n").agg(F.count_distinct("cls").alias("c"))  # a row for each small size
    boundary = size_boundary(percent, {r.n: r.c for r in sizes.collect()}, sums[0] or 0.0)
    table = write_shared(nodes(docs, shared, first, size, percent, boundary, shards), "shingle_sets")
    return classes, components(list_links(table, percent, subset_links(table, percent)))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable by links, its own included).

    Texts are lower-cased (A-Z); a set is the distinct ``size``-word shingles, with fewer words the whole sequence. Two link when
    their intersection is at least ``percent`` of their union. Null, empty and wordless texts are empty sets and link with nothing. Rows with
    equal sets are linked, repeated rows too. Rows without an id take part; where a component has no id, component_id is null.
    Only doc_id and text are read.
    """
    table, label = _classes(stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), text), size, percent)
    smallest = table.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = smallest.join(label, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = named.join(of, "component").select("cls", "component_id")
    return (table.select("doc_id", "n", "cls").join(joined, "cls", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, of equal ids the first read, a row without id
    only if no other is there. Rows with empty sets stay. The texts do not move: the chunks are told which rows to keep."""
    staged = stage(docs, text)
    order = staged.row
    table, label = _classes(staged, size, percent)
    rows = table.select("cls", "n", order_key("doc_id").alias("id"), "row", "chunk")
    first = (rows.filter("n > 0").join(label, "cls", "left").groupBy(F.coalesce("component", "cls").alias("component"))
             .agg(F.min(F.struct("id", "row", "chunk")).alias("first")).select("first.chunk", "first.row"))
    kept = first.unionByName(rows.filter("n = 0").select("chunk", "row"))

    def choose(docs: pa.Table, kept: pa.Table) -> pa.Table:
        docs = docs.filter(pc.is_in(docs.column(order), value_set=kept.column("row").combine_chunks()))
        return docs.select(columns)

    columns = list(docs.columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return staged.table.groupBy(staged.chunk).cogroup(kept.groupBy("chunk")).applyInArrow(choose, fields)
