"""Windows of tokens repeated from a smaller document: the passes that two operators share.

Both operators remove every token covered by a window of fixed length that also starts in a document
with a smaller id. The texts stay in the chunks where ``staging.stage`` put them; the passes send hashes to
shards and answers back:

1. ``anchor_cells``: windows are grouped by the short gram inside them that has the smallest hash, the
   *anchor* (``vectors.segments``). Each chunk sends every distinct anchor once, as a 32-bit
   cell of its shard, with a counter of one or of more.
2. ``repeated_cells``: a shard adds up the counters of all chunks. A cell counted once belongs to
   an anchor, and so to windows, found once in the corpus; every other cell goes back to its chunks.
   Cells may collide, so counts are never too small and no repeat is lost.
3. ``shipped_segments``: chunks send the windows of the anchors counted twice or more. Equal
   segments inside a chunk are sent once, from the smallest document; in the others all is covered.
   So a passage copied any number of times sends at most one segment from each chunk.
4. ``covered_windows``: a shard compares the windows exactly and tells which are covered.
5. ``cover``: chunks mark the covered tokens in the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stationhour.llm import vectors as V
from stationhour.llm.staging import Staged

_U = np.uint64
_ONE = np.iinfo(np.int64)


@dataclass(frozen=True)
class Tokens:
    """The tokens of one slice: hashes, bounds of the documents, and (for words) byte spans."""

    values: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    byte_bounds: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None


@dataclass(frozen=True)
class Windows:
    """What differs between the two operators."""

    length: int
    gram: int
    tokens: Callable[[np.ndarray, np.ndarray], Tokens]
    # (tokens, first window, last window) -> payload bytes of each segment, and their sizes
    payload: Callable[[Tokens, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    # (payload, windows of each segment) -> group number of every window
    groups: Callable[[np.ndarray, np.ndarray], np.ndarray]

    def __post_init__(self):
        if not 0 <= self.length - self.gram < 32:
            raise ValueError("a segment has at most 32 windows")


def _anchors(kind: Windows, data: np.ndarray, bounds: np.ndarray):
    tokens = kind.tokens(data, bounds)
    grams = V.Rolling(tokens.values).all(kind.gram)
    first, last, at = V.segments(grams, tokens.bounds, len(tokens.values), kind.length, kind.gram)
    # anchors are minima: mix again, or small hashes would crowd the first shards
    return tokens, first, last, V.mix(grams[at] ^ _U(0x5851F42D4C957F2D))


def _place(anchor: np.ndarray, shards: int) -> np.ndarray:
    """Shard in the upper half, cell of the shard in the lower."""
    shard = ((anchor >> _U(32)) * _U(shards)) >> _U(32)
    return shard << _U(32) | (anchor & _U(0xFFFFFFFF))


def _by_shard(place: np.ndarray, shards: int) -> np.ndarray:
    """Positions in sorted places where each shard starts, and the end."""
    return np.searchsorted(place, np.arange(shards + 1, dtype=np.uint64) << _U(32))


def keys_of(table: pa.Table, name: str = "doc_id") -> np.ndarray:
    """Document ids for comparison; null comes after every id."""
    return table.column(name).cast(pa.int64()).fill_null(_ONE.max).to_numpy()


def _nothing(schema: pa.Schema) -> pa.Table:
    return schema.empty_table()


def anchor_cells(staged: Staged, kind: Windows) -> DataFrame:
    shards, text, chunk = staged.shards, staged.text, staged.chunk
    schema = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

    def sketch(table: pa.Table) -> pa.Table:
        seen = [_place(_anchors(kind, data, bounds)[3], shards) for _, _, data, bounds in V.slices(table, text)]
        cells, counts = np.unique(np.concatenate(seen or [np.empty(0, np.uint64)]), return_counts=True)
        at = _by_shard(cells, shards)
        number = table.column(chunk)[0].as_py()
        own, once = cells.astype(np.uint32), counts == 1
        rows = [(s, own[a:b][once[a:b]].tobytes(), own[a:b][~once[a:b]].tobytes())
                for s, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
        if not rows:
            return _nothing(schema)
        shard, single, several = zip(*rows, strict=True)
        return pa.table([pa.array([number] * len(rows), pa.int32()), pa.array(shard, pa.int32()),
                         pa.array(single, pa.binary()), pa.array(several, pa.binary())], schema=schema)

    return (staged.table.select(chunk, text).groupBy(chunk)
            .applyInArrow(sketch, "chunk int, shard int, once binary, more binary"))


def repeated_cells(cells: DataFrame) -> DataFrame:
    schema = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("cells", pa.binary())])

    def merge(table: pa.Table) -> pa.Table:
        once, more = table.column("once").to_pylist(), table.column("more").to_pylist()
        total = np.sort(np.concatenate([V.unpack(once, np.uint32), np.repeat(V.unpack(more, np.uint32), 2)]))
        hot = np.unique(total[1:][total[1:] == total[:-1]])
        if not len(hot):
            return _nothing(schema)
        chunks, found = [], []
        for number, a, b in zip(table.column("chunk").to_pylist(), once, more, strict=True):
            own = V.unpack([a, b], np.uint32)
            own = own[hot[np.minimum(np.searchsorted(hot, own), len(hot) - 1)] == own]
            if len(own):
                chunks.append(number)
                found.append(own.tobytes())
        shard = table.column("shard")[0].as_py()
        return pa.table([pa.array(chunks, pa.int32()), pa.array([shard] * len(chunks), pa.int32()),
                         pa.array(found, pa.binary())], schema=schema)

    return cells.groupBy("shard").applyInArrow(merge, "chunk int, shard int, cells binary")


# one row: segments of one chunk for one shard (size > 0 windows each), or spans covered inside a chunk
_SHIPPED = "chunk int, shard int, docs binary, rows binary, first binary, windows binary, payload binary, covered boolean"
_SHIPPED_SCHEMA = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("docs", pa.binary()), ("rows", pa.binary()),
                             ("first", pa.binary()), ("windows", pa.binary()), ("payload", pa.binary()), ("covered", pa.bool_())])


def _in(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(wanted), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)] == wanted


def merged_spans(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unite overlapping or touching spans of each row; sorted by (row, start)."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    base = row.astype(np.int64) << 32  # rows kept apart, so that one running maximum serves all
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(row), bool)
    new[1:] = base[1:] + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row)) - 1
    return row[at], start[at], reach[last] - base[at]


def shipped_segments(staged: Staged, kind: Windows, repeated: DataFrame) -> DataFrame:
    shards, text, order, chunk = staged.shards, staged.text, staged.row, staged.chunk

    def ship(docs: pa.Table, hot: pa.Table) -> pa.Table:
        if not docs.num_rows or not hot.num_rows:
            return _nothing(_SHIPPED_SCHEMA)
        docs = docs.sort_by(order)
        wanted = np.sort(np.concatenate([_U(s) << _U(32) | np.frombuffer(c, np.uint32).astype(np.uint64) for s, c in
                                         zip(hot.column("shard").to_pylist(), hot.column("cells").to_pylist(), strict=True)]))
        doc = keys_of(docs)
        parts = []
        for row, _, data, bounds in V.slices(docs, text):
            tokens, first, last, anchor = _anchors(kind, data, bounds)
            place = _place(anchor, shards)
            keep = _in(wanted, place)
            first, last, place = first[keep], last[keep], place[keep]
            own = np.searchsorted(tokens.bounds, first, "right") - 1
            whole = V.Rolling(tokens.values).of(first, last + kind.length)
            payload, size = kind.payload(tokens, first, last)
            parts.append((place, whole, row + own, first - tokens.bounds[own], last - first + 1, size, payload))
        columns = list(zip(*parts, strict=True))
        number = docs.column(chunk)[0].as_py()
        del parts, docs, hot, wanted
        place, whole, rows, first, windows, size, payload = (np.concatenate(columns.pop(0)) for _ in range(7))
        # equal segments of this chunk: sent from the smallest document only
        by = np.lexsort((rows, doc[rows], whole, place))
        same = np.zeros(len(by), bool)
        same[1:] = (place[by][1:] == place[by][:-1]) & (whole[by][1:] == whole[by][:-1]) & (windows[by][1:] == windows[by][:-1])
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))
        later = doc[rows[by]] > doc[rows[by[head]]]
        gone, sent = by[later], by[~later]
        offset = np.concatenate([[0], np.cumsum(size)])
        at = _by_shard(place[sent], shards)
        out = []
        for s, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if b > a:
                i = sent[a:b]
                out.append((number, s, V.pack(doc[rows[i]]), V.pack(rows[i].astype(np.uint32)), V.pack(first[i].astype(np.uint32)),
                            V.pack(windows[i].astype(np.uint8)), V.pack(payload[V.ragged(offset[i], size[i])]), False))
        if len(gone):
            r, a, b = merged_spans(rows[gone], first[gone], first[gone] + windows[gone] + kind.length - 1)
            out.append((number, number % shards, b"", V.pack(r.astype(np.uint32)), V.pack(a.astype(np.uint32)),
                        V.pack((b - a).astype(np.uint32)), b"", True))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _SHIPPED_SCHEMA, strict=True)],
                        schema=_SHIPPED_SCHEMA) if out else _nothing(_SHIPPED_SCHEMA)

    return (staged.table.select(chunk, order, "doc_id", text).groupBy(chunk)
            .cogroup(repeated.groupBy("chunk")).applyInArrow(ship, _SHIPPED))


def covered_windows(shipped: DataFrame, kind: Windows) -> DataFrame:
    """Spans of tokens covered by windows of smaller documents: (chunk, rows, first, length) packed."""
    schema = pa.schema([("chunk", pa.int32()), ("rows", pa.binary()), ("first", pa.binary()), ("size", pa.binary())])

    def compare(table: pa.Table) -> pa.Table:
        inside = table.filter(table.column("covered"))
        out = list(zip(*(inside.column(c).to_pylist() for c in ("chunk", "rows", "first", "windows")), strict=True))
        table = table.filter(pc.invert(table.column("covered")))
        if table.num_rows:
            doc, rows, first, windows = (V.unpack(table.column(c).to_pylist(), k) for c, k in
                                         (("docs", np.int64), ("rows", np.uint32), ("first", np.uint32), ("windows", np.uint8)))
            size = windows.astype(np.int64)
            group = kind.groups(np.frombuffer(b"".join(table.column("payload").to_pylist()), np.uint8), size)
            owner = np.repeat(np.arange(len(size)), size)
            least = np.full(int(group.max()) + 1, _ONE.max, np.int64)
            by = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.append(True, group[by][1:] != group[by][:-1]))
            least[group[by][starts]] = np.minimum.reduceat(doc[owner[by]], starts)
            over = np.flatnonzero(doc[owner] > least[group])
            window = V.ragged(first.astype(np.int64), size)[over]
            parts = np.searchsorted(np.cumsum([len(x) // 4 for x in table.column("rows").to_pylist()]), owner[over], "right")
            cuts = np.searchsorted(parts, np.arange(table.num_rows + 1))
            for i, number in enumerate(table.column("chunk").to_pylist()):
                a, b = cuts[i], cuts[i + 1]
                if b > a:
                    r, s, e = merged_spans(rows[owner[over[a:b]]].astype(np.int64), window[a:b], window[a:b] + kind.length)
                    out.append((number, V.pack(r.astype(np.uint32)), V.pack(s.astype(np.uint32)), V.pack((e - s).astype(np.uint32))))
        if not out:
            return _nothing(schema)
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return shipped.groupBy("shard").applyInArrow(compare, "chunk int, rows binary, first binary, size binary")


def cover(staged: Staged, kind: Windows, spans: DataFrame, schema: str, columns: list[str],
          finish: Callable[[Tokens, np.ndarray], list[pa.Array]]) -> DataFrame:
    """Mark the covered tokens. ``finish`` makes the result columns of a slice from its tokens and marks;
    ``columns`` of the documents come before them."""
    text, order = staged.text, staged.row

    def mark(docs: pa.Table, found: pa.Table) -> Iterator[pa.RecordBatch] | pa.Table:
        docs = docs.sort_by(order)
        row, start, end = merged_spans(*_spans(found))
        parts = []
        for a, b, data, bounds in V.slices(docs, text):
            tokens = kind.tokens(data, bounds)
            i, j = np.searchsorted(row, [a, b])
            base = tokens.bounds[row[i:j] - a]
            change = np.zeros(len(tokens.values) + 1, np.int8)
            change[base + start[i:j]] += 1  # spans of a row neither overlap nor touch
            change[base + end[i:j]] -= 1
            marks = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
            parts.append(finish(tokens, marks))
        kept = [docs.column(c) for c in columns]
        made = [pa.chunked_array(list(x)) for x in zip(*parts, strict=True)] if parts else []
        return pa.table(kept + made, names=names)

    names = columns + [c.strip().rsplit(" ", 1)[0].strip("`") for c in schema.split(",")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in staged.table.schema if f.name in columns)
    return (staged.table.select(staged.chunk, order, *dict.fromkeys([text, *columns])).groupBy(staged.chunk)
            .cogroup(spans.groupBy("chunk")).applyInArrow(mark, f"{fields}, {schema}"))


def _spans(found: pa.Table):
    row, start, size = (V.unpack(found.column(c).to_pylist(), np.uint32).astype(np.int64) for c in ("rows", "first", "size"))
    return row, start, start + size


def repeated_spans(staged: Staged, kind: Windows) -> DataFrame:
    """Passes 1 to 4."""
    repeated = repeated_cells(anchor_cells(staged, kind))
    return covered_windows(shipped_segments(staged, kind, repeated), kind)
