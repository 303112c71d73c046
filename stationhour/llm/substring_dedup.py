"""Substring dedup over words: count-min prefilter, then exact groups.

* **Sketch** (``window_sketches``). Each chunk of the corpus counts its windows in a count-min sketch of ``ROWS`` rows. A row has
  ``shards`` parts of ``COUNTERS`` counters; a chunk sends the counters that it raised, part by part.
* **Merge** (``repeated_counters``). A part is one dense array to which the sketches of all chunks are added. Each chunk is told which of its counters
  reach two.
* **Estimate** (``estimated_repeats``). A window's estimate is the smallest of its ``ROWS`` counters. Counters only collide upwards, so an estimate
  is never below the window's count and no repeat is lost. With as many shards as chunks a row has 2**24 counters for the windows of 16 MB of
  text, about six a window: a window found once passes with a probability of (1 - exp(-1/6))**2, some 2.4 per cent, at every size of corpus.
* **Exact groups** (``least_ids``). Of each window estimated as repeated a chunk sends its 128-bit hash and its smallest document once, to the shard of
  that hash. So a group has one row a chunk at most, whatever stands around the window and however often a chunk repeats it.
* **Cover** (``_cover``). The shards tell the chunks which windows start in a smaller document of another chunk; chunks mark the words these cover.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationhour.llm import vectors as V
from stationhour.llm.repeats import keys_of, merged_spans
from stationhour.llm.staging import Staged, stage

ROWS = 2
_BITS = 24
COUNTERS = 1 << _BITS
RESULT = "n_words long, n_removed long, kept_text string"
_U = np.uint64


class Words:
    """The words of a slice and its windows: first word and 128-bit hash of each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int):
        self.data = data
        self.start, self.end, self.bounds = V.words(data, bounds)
        self.first = np.flatnonzero(V.window_starts(self.bounds, len(self.start), length))
        self.hashes = np.empty((2, len(self.first)), np.uint64)
        for i in range(2):
            self.hashes[i] = V.Rolling(V.word_hashes(data, self.start, self.end, i), i).all(length)[self.first]


def counters_of(hashes: np.ndarray, row: int, shards: int) -> np.ndarray:
    """Places of windows in one row of the sketch: the part in the upper bits, the counter of the part in the lower."""
    value = V.mix(hashes[0] + _U(row) * hashes[1])
    part = _U(row * shards) + (((value >> _U(32)) * _U(shards)) >> _U(32))
    return part << _U(_BITS) | (value & _U(COUNTERS - 1))


def _packed(counters: np.ndarray) -> bytes:
    """Ascending counters of one part as steps, byte planes apart."""
    steps = np.diff(counters.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4)[:, :3].T).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(3, -1).astype(np.uint32)
    return np.cumsum(planes[0] | planes[1] << np.uint32(8) | planes[2] << np.uint32(16), dtype=np.uint32)


def _filled(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    if not rows:
        return schema.empty_table()
    return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _tasks(staged: Staged) -> int:
    """Tasks of a shuffle by part or shard: they follow the chunks, so that a task's share does not grow with the corpus."""
    return max(int(staged.table.sparkSession.conf.get("spark.sql.shuffle.partitions")), staged.chunks)


def window_sketches(staged: Staged, length: int) -> DataFrame:
    """The counters that each chunk raises: once, and twice or more."""
    shards, text, chunk = staged.shards, staged.text, staged.chunk
    schema = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

    def sketch(table: pa.Table) -> pa.Table:
        number, out = table.column(chunk)[0].as_py(), []
        hashes = [Words(data, bounds, length).hashes for _, _, data, bounds in V.slices(table, text)]
        for row in range(ROWS):
            places = np.concatenate([counters_of(h, row, shards) for h in hashes] or [np.empty(0, np.uint64)])
            places, counts = np.unique(places, return_counts=True)
            part, counter, once = (places >> _U(_BITS)).astype(np.int64), places & _U(COUNTERS - 1), counts == 1
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own, one = counter[a:b], once[a:b]
                out.append((number, int(part[a]), _packed(own[one]), _packed(own[~one])))
        return _filled(out, schema)

    return (staged.table.select(chunk, text).groupBy(chunk)
            .applyInArrow(sketch, "chunk int, part int, once binary, more binary"))


def repeated_counters(sketches: DataFrame, tasks: int) -> DataFrame:
    """The sketches merged by addition, in saturating counters; to each chunk those of its counters that reach two."""
    schema = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("counters", pa.binary())])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS, np.uint8)
        blobs = list(zip(*(table.column(c).to_pylist() for c in ("chunk", "part", "once", "more")), strict=True))
        for _, _, once, more in blobs:
            for blob, count in ((once, 1), (more, 2)):
                own = _unpacked(blob)
                total[own] = np.minimum(total[own], 255 - count) + count
        out = []
        for number, part, once, more in blobs:
            own = np.concatenate([_unpacked(once), _unpacked(more)])
            own = np.sort(own[total[own] > 1])
            if len(own):
                out.append((number, part, _packed(own)))
        return _filled(out, schema)

    return sketches.repartition(tasks, "part").groupBy("part").applyInArrow(merge, "chunk int, part int, counters binary")


def _among(ascending: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(wanted), bool)
    return ascending[np.minimum(np.searchsorted(ascending, wanted), len(ascending) - 1)] == wanted


# a row for a shard: hashes and smallest documents of windows; or a row for the chunk itself: spans covered by its own documents
_FOUND = "chunk int, shard int, hashes binary, docs binary, rows binary, first binary, size binary"
_FOUND_SCHEMA = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), *[(c, pa.binary()) for c in ("hashes", "docs", "rows", "first", "size")]])


def estimated_repeats(staged: Staged, length: int, counters: DataFrame) -> DataFrame:
    shards, text, order, chunk = staged.shards, staged.text, staged.row, staged.chunk

    def find(docs: pa.Table, hot: pa.Table) -> pa.Table:
        if not docs.num_rows or not hot.num_rows:
            return _FOUND_SCHEMA.empty_table()
        docs, hot = docs.sort_by(order), hot.sort_by("part")
        wanted = np.concatenate([_U(p) << _U(_BITS) | _unpacked(c).astype(np.uint64) for p, c in
                                 zip(hot.column("part").to_pylist(), hot.column("counters").to_pylist(), strict=True)])
        doc, number, parts = keys_of(docs), docs.column(chunk)[0].as_py(), []
        for row, _, data, bounds in V.slices(docs, text):
            words = Words(data, bounds, length)
            keep = np.arange(len(words.first))
            for r in range(ROWS):  # the smallest counter is two or more where all are
                keep = keep[_among(wanted, counters_of(words.hashes[:, keep], r, shards))]
            first = words.first[keep]
            own = np.searchsorted(words.bounds, first, "right") - 1
            parts.append((words.hashes[:, keep], row + own, first - words.bounds[own]))
        del docs, hot, wanted
        hashes = np.concatenate([p[0] for p in parts], axis=1)
        rows, first = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        del parts
        by = np.lexsort((doc[rows], hashes[1], hashes[0]))
        hashes, rows, first = hashes[:, by], rows[by], first[by]
        new = np.ones(len(by), bool)
        new[1:] = (hashes[:, 1:] != hashes[:, :-1]).any(axis=0)
        head = np.flatnonzero(new)
        least = doc[rows[head]]
        later = doc[rows] > least[np.cumsum(new) - 1]
        out = []
        if later.any():
            r, a, b = merged_spans(rows[later], first[later], first[later] + length)
            out.append((number, -1, b"", b"", *(V.pack(x.astype(np.uint32)) for x in (r, a, b - a))))
        hashes = hashes[:, head]
        shard = ((hashes[0] >> _U(32)) * _U(shards)) >> _U(32)  # ascends with the hash
        cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        narrow = np.uint32 if len(least) and 0 <= least.min() and least.max() < 1 << 32 else np.int64
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[s], cuts[s + 1]
            out.append((number, s, V.pack(hashes[:, a:b]), V.pack(least[a:b].astype(narrow)), None, None, None))
        return _filled(out, _FOUND_SCHEMA)

    return (staged.table.select(chunk, order, "doc_id", text).groupBy(chunk)
            .cogroup(counters.groupBy("chunk")).applyInArrow(find, _FOUND))


def least_ids(found: DataFrame, tasks: int) -> DataFrame:
    """To each chunk the windows that start in a smaller document of another chunk; spans inside chunks pass through."""

    def compare(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:
            return table.select(_FOUND_SCHEMA.names)
        chunk, blobs = table.column("chunk").to_pylist(), table.column("hashes").to_pylist()
        sizes = np.array([len(x) // 16 for x in blobs])
        hashes = np.concatenate([np.frombuffer(x, np.uint64).reshape(2, -1) for x in blobs], axis=1)
        doc = np.concatenate([np.frombuffer(x, np.uint32 if len(x) == 4 * n else np.int64).astype(np.int64)
                              for x, n in zip(table.column("docs").to_pylist(), sizes, strict=True)])
        by = np.lexsort((doc, hashes[1], hashes[0]))
        new = np.ones(len(by), bool)
        new[1:] = (hashes[:, by[1:]] != hashes[:, by[:-1]]).any(axis=0)
        least = doc[by[np.flatnonzero(new)]]
        over = np.empty(len(by), bool)
        over[by] = doc[by] > least[np.cumsum(new) - 1]
        edge = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for number, a, b in zip(chunk, edge[:-1], edge[1:], strict=True):
            own = hashes[:, a:b][:, over[a:b]]
            if own.shape[1]:
                out.append((number, 0, V.pack(own), None, None, None, None))
        return _filled(out, _FOUND_SCHEMA)

    # spans for a chunk itself have shard -1, one row a chunk; they are grouped apart from each other
    return (found.withColumn("own", F.when(F.col("shard") < 0, F.col("chunk"))).repartition(tasks, "shard", "own")
            .groupBy("shard", "own").applyInArrow(compare, _FOUND))


def _finish(words: Words, removed: np.ndarray) -> list[pa.Array]:
    """Kept words joined by one space, document by document."""
    total = np.diff(words.bounds)
    gone = np.concatenate([[0], np.cumsum(removed)])
    gone = gone[words.bounds[1:]] - gone[words.bounds[:-1]]
    keep = np.flatnonzero(~removed)
    size = words.end[keep] - words.start[keep]
    offset = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(offset[-1], 0x20, np.uint8)
    out[V.ragged(offset[:-1], size)] = words.data[V.ragged(words.start[keep], size)]
    first = np.searchsorted(keep, words.bounds)
    begin, end = offset[first[:-1]], offset[first[1:]]
    end = np.where(end > begin, end - 1, end)  # no space after a document's last word
    where = V.ragged(begin, end - begin)
    bounds = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    text = pa.StringArray.from_buffers(len(total), pa.py_buffer(bounds), pa.py_buffer(out[where]))
    return [pa.array(total.astype(np.int64)), pa.array(gone.astype(np.int64)), text]


def _cover(staged: Staged, length: int, answers: DataFrame, columns: list[str]) -> DataFrame:
    """Mark the words covered: by spans found inside a chunk, and by all windows of the answers."""
    text, order = staged.text, staged.row

    def mark(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs = docs.sort_by(order)
        blobs = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in found.column("hashes").to_pylist()]
        wanted = np.concatenate([np.empty((2, 0), np.uint64), *blobs], axis=1)
        wanted = wanted[:, np.lexsort((wanted[1], wanted[0]))]
        inside = found.filter(found.column("rows").is_valid())
        row, start, size = (V.unpack(inside.column(c).to_pylist(), np.uint32).astype(np.int64) for c in ("rows", "first", "size"))
        parts = []
        for a, b, data, bounds in V.slices(docs, text):
            words = Words(data, bounds, length)
            change = np.zeros(len(words.start) + 1, np.int32)
            i, j = np.searchsorted(row, [a, b])
            base = words.bounds[row[i:j] - a]
            change[base + start[i:j]] += 1  # spans of a row neither overlap nor touch
            change[base + start[i:j] + size[i:j]] -= 1
            hit = words.first[_pairs_among(wanted, words.hashes)]
            change[hit] += 1
            change[hit + length] -= 1
            parts.append(_finish(words, np.cumsum(change[:-1]) > 0))
        made = [pa.chunked_array(list(x)) for x in zip(*parts, strict=True)] if parts else []
        return pa.table([*(docs.column(c) for c in columns), *made], names=names)

    names = [*columns, *(c.split()[0] for c in RESULT.split(", "))]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.table.schema if f.name in columns)
    return (staged.table.select(staged.chunk, order, *dict.fromkeys([text, *columns])).groupBy(staged.chunk)
            .cogroup(answers.groupBy("chunk")).applyInArrow(mark, f"{fields}, {RESULT}"))


def _pairs_among(ascending: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which 128-bit hashes are among ascending ones? Equal first halves stand side by side."""
    out = np.zeros(wanted.shape[1], bool)
    open_ = np.flatnonzero(_among(ascending[0], wanted[0]))
    at = np.searchsorted(ascending[0], wanted[0, open_])
    while len(open_):
        out[open_[ascending[1, at] == wanted[1, open_]]] = True
        at = at + 1
        go = np.flatnonzero((at < ascending.shape[1]) & ~out[open_])
        go = go[ascending[0, at[go]] == wanted[0, open_[go]]]
        open_, at = open_[go], at[go]
    return out


def remove_repeated_words(docs: DataFrame, length: int = 13, text: str = "text") -> DataFrame:
    """Remove each word covered by ``length`` consecutive words that also start in a smaller document.

    Returns one row per row of ``docs``: its columns except ``text``, then n_words, n_removed and kept_text (the
    kept words joined by one space). Null and empty texts have no words; a text of any length is one piece. Rows with equal ids do
    not remove from one another; rows without an id come after all others, and not from one another. Windows never
    cross documents. A column of ``docs`` named like a result column is replaced.
    """
    made = {"n_words", "n_removed", "kept_text"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in made])
    staged = stage(docs, text)
    tasks = _tasks(staged)
    counters = repeated_counters(window_sketches(staged, length), tasks)
    answers = least_ids(estimated_repeats(staged, length, counters), tasks)
    return _cover(staged, length, answers, [c for c in docs.columns if c != text])
