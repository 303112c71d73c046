"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over token positions: positions it leaves out may differ. The masks follow from the length of an
item and the substitutions it allows, so that every allowed overlap holds a seed. Seeds of the test items and of all
training texts are hashed and joined; around every hit the item and the text are laid side by side and
the overlap is verified token by token, substitutions allowed.

The test items are the stated query set: they go to the tasks in blocks of bounded size, one scan of the corpus
for each block; the plan, and so the driver, holds all blocks. Nothing of the corpus is shuffled or collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationhour.llm import vectors as V

# Token positions that a seed looks at. Any 13 tokens with at most 2 substitutions hold one of them whole.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
# Lengths that masks of short items are made for. An item has the masks of the last that fits into it.
LENGTHS = (1, 2, 3, 4, 5, 8, 10)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, case folded by Unicode, and each document's part of them."""
    if len(data) and data.max() >= 0x80:  # folding can change the bytes of a text; bytes that are no UTF-8 stay
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
                 for a, b in pairwise(bounds.tolist())]
        data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    else:
        data = _LOWER[data]
    start, end, at = V.words(data, bounds)
    return V.word_hashes(data, start, end), at


def allowed(words: int, share: float) -> int:
    """How many of ``words`` may differ where ``share`` of them must be equal."""
    return words - int(np.ceil(share * words - 1e-9))


def masks_of(length: int, least: int, share: float) -> tuple[tuple[int, ...], ...]:
    """Masks for items of ``length`` words: each overlap holds one of them whole.

    In items of ``least`` words and more they may stand anywhere, in shorter ones at the item's start. With k substitutions, the
    words are cut into k + 2 parts; some two parts are whole, and each two parts are a mask.
    """
    words = min(length, least)
    gone = allowed(words, share)
    if length >= least and words >= 13 and gone <= 2:
        return MASKS
    if length < least:
        words = max([n for n in LENGTHS if n <= words])
    gone = min(gone, words - 1)
    parts = np.array_split(np.arange(words), min(gone + 2, words))
    return tuple(tuple(np.concatenate(x).tolist()) for x in combinations(parts, len(parts) - gone))


def _seeds(tokens: np.ndarray, bounds: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first position) of one mask at every place where it fits into a document."""
    span = mask[-1] + 1
    n = len(tokens) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i, at in enumerate(mask):
        total += tokens[at:at + n] * V.power(1, len(mask) + 1)[i + 1]
    at = np.flatnonzero(V.window_starts(bounds, len(tokens), span))
    return V.mix(total)[at], at


class Items:
    """One block of test items, indexed by their seeds."""

    def __init__(self, ids: list[int], texts: list[str | None], least: int, share: float):
        data, sizes = [], []
        for t in texts:
            data.append((t or "").encode())
            sizes.append(len(data[-1]))
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ids = np.array(ids, np.int64)
        self.tokens, self.bounds = _tokens(np.frombuffer(b"".join(data), np.uint8), bounds)
        self.least, self.share = least, share
        words = np.diff(self.bounds)
        sizes = np.minimum(words, least)
        wanted: dict[tuple[int, ...], set[int]] = {}
        for n in np.unique(sizes[sizes > 0]).tolist():
            for mask in masks_of(n, least, share):
                wanted.setdefault(mask, set()).add(n)
        self.index = []  # of each mask: its sorted seeds and their places
        for mask, lengths in wanted.items():
            seeds, places = _seeds(self.tokens, self.bounds, mask)
            item = np.searchsorted(self.bounds, places, "right") - 1
            own = np.isin(sizes[item], list(lengths)) & ((words[item] >= least) | (places == self.bounds[item]))
            seeds, places = seeds[own], places[own]
            order = np.argsort(seeds, kind="stable")
            self.index.append((mask, seeds[order], places[order]))

    def overlaps(self, data: np.ndarray, bounds: np.ndarray, cells: int = 1 << 22):
        """(row, item, matched, first word, words) of verified overlaps, the best of each row and item. ``cells`` bounds the words that are laid side by side at
        a time; one alignment is never cut."""
        empty = (np.empty(0, np.int64),) * 5
        tokens, at = _tokens(data, bounds)
        hit_at, hit_item = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for mask, known, places in self.index:
            seeds, place = _seeds(tokens, at, mask)
            first, last = np.searchsorted(known, seeds), np.searchsorted(known, seeds, "right")
            hit = np.flatnonzero(last > first)
            many = last[hit] - first[hit]
            hit_at.append(np.repeat(place[hit], many))
            hit_item.append(places[V.ragged(first[hit], many)])
        where, there = np.concatenate(hit_at), np.concatenate(hit_item)
        if not len(where):
            return empty
        row = np.searchsorted(at, where, "right") - 1
        item = np.searchsorted(self.bounds, there, "right") - 1
        # hits on one diagonal are one alignment
        key = np.lexsort((where - there, item, row))
        same = np.stack([row, item, where - there])[:, key]
        key = key[np.append(True, (same[:, 1:] != same[:, :-1]).any(axis=0))]
        where, there, row, item = where[key], there[key], row[key], item[key]
        back = np.minimum(where - at[row], there - self.bounds[item])
        size = np.minimum(at[row + 1] - where, self.bounds[item + 1] - there) + back
        part = np.cumsum(size) // cells
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        parts = [self._verify(tokens, at, (where - back)[a:b], (there - back)[a:b], size[a:b], row[a:b], item[a:b]) for a, b in pairwise(cuts)]
        row, item, matched, first, words = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((first, -words, -matched, item, row))
        keep = np.append(True, (row[order][1:] != row[order][:-1]) | (item[order][1:] != item[order][:-1]))[:len(order)]
        order = order[keep]
        return row[order], item[order], matched[order], first[order], words[order]

    def _verify(self, tokens, at, x, y, size, row, item):
        """Overlaps along whole alignments, which begin at the words ``x`` and ``y`` and have ``size`` words: all windows of ``least`` words with enough
        equal ones, united."""
        equal = tokens[V.ragged(x, size)] == self.tokens[V.ragged(y, size)]
        alike = np.concatenate([[0], np.cumsum(equal)])
        edge = np.concatenate([[0], np.cumsum(size)])
        needed = np.minimum(self.least, np.diff(self.bounds)[item])
        window = np.repeat(needed, size)
        begin = np.arange(len(equal))
        end = begin + window
        inside = end <= np.repeat(edge[1:], size)
        good = np.flatnonzero(inside & (alike[np.minimum(end, len(equal))] - alike[begin] >= np.ceil(self.share * window - 1e-9)))
        of = np.searchsorted(edge, good, "right") - 1
        hit, one = np.unique(of, return_index=True)
        first = good[one]
        last = good[(np.append(one[1:], len(good)) - 1)[:len(hit)]] + needed[hit]
        return row[hit], item[hit], (alike[last] - alike[first]).astype(np.int64), x[hit] + first - edge[hit] - at[row[hit]], last - first


def _blocks(benchmark: DataFrame, block_bytes: int, least: int, share: float) -> Iterator[Items]:
    """The items in blocks of about ``block_bytes`` of text."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        ids.append(-1 if r.item_id is None else r.item_id)
        texts.append(r.text)
        size += len(r.text or "")
        if size >= block_bytes:
            yield Items(ids, texts, least, share)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, least, share)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8,
                 block_bytes: int = 4 << 20) -> DataFrame:
    """One row per document and test item that overlap: doc_id, item_id, matched_words, first_word, overlap_words.

    An overlap is made of stretches of ``least`` consecutive words (the whole item if it is shorter), case folded by Unicode, in each
    of which at least ``share`` are equal place by place; short items are searched at every place, also those of one word. Null
    and empty texts overlap with nothing; null ids are carried (a null item id as -1); repeated rows are reported
    for each row. An empty benchmark gives an empty result. An overlap of any length is reported whole, from the first to the last such stretch of one
    alignment; of several alignments of a text and an item the one with most equal words.
    """
    schema = "doc_id long, item_id long, matched_words long, first_word long, overlap_words long"
    names = [x.split()[0] for x in schema.split(", ")]

    def scan(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches):
            for batch in batches:
                table = pa.Table.from_batches([batch])
                for a, b, data, bounds in V.slices(table, "text"):
                    row, item, *rest = items.overlaps(data, bounds)
                    if len(row):
                        own = table.column("doc_id").slice(a, b - a).take(pa.array(row)).combine_chunks()
                        yield pa.RecordBatch.from_arrays([own, *map(pa.array, [items.ids[item], *rest])], names=names)
        return run

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, block_bytes, least, share):
        out = out.unionByName(docs.mapInArrow(scan(items), schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.8,
                  block_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` without the rows that overlap with a test item, as ``contaminated`` finds them."""

    def scan(items: Items):
        def run(batches):
            for batch in batches:
                table = pa.Table.from_batches([batch])
                clean = np.ones(table.num_rows, bool)
                for a, b, data, bounds in V.slices(table, "text"):
                    clean[a + items.overlaps(data, bounds)[0]] = False
                kept = table.filter(pa.array(clean))
                yield from kept.to_batches()
        return run

    for items in _blocks(benchmark, block_bytes, least, share):
        docs = docs.mapInArrow(scan(items), docs.schema)
    return docs
