"""Pack documents into token sequences of a fixed length, in their order.

Texts are cut into the tokeniser's words first (its published pattern, here by character classes), so that
only words new to the task are encoded. Windows are then chosen by dynamic programming over
document and sentence ends::

    best[i] = penalty[i] + min over earlier j of best[j] + padding(i - j) + cut * (full windows inside)

For a fixed number of windows between j and i, the cost is best[j] + position[j] plus a term of i alone, so the best j of a
sliding range is kept in a monotone queue: each end enters and leaves each queue once.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from stationhour.llm import vectors as V

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "padded_length long")

_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
_KNOWN = 0x280  # characters below are classed here (lead bytes below 0xCA), texts with others are encoded whole


def _classes() -> np.ndarray:
    kind = [{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(_KNOWN)]
    out = np.array(kind, np.uint8)
    out[list(V.SPACES)] = _SPACE
    return out


_CLASS = _classes()


def _plain(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents of which every character can be classed: below U+0280, no spaces but the ASCII ones."""
    odd = (data >= 0xCA) | ((data >= 0x1C) & (data <= 0x1F))
    if len(data) > 1:
        odd[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    total = np.concatenate([[0], np.cumsum(odd)])
    return total[bounds[1:]] == total[bounds[:-1]]


def pieces(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start of every word of the byte-level pattern, for plain documents."""
    n = len(data)
    kind = _CLASS[data & 0x7F]
    lead = np.flatnonzero(data >= 0xC0)
    code = ((data[lead] & 0x1F).astype(np.int64) << 6) | (data[lead + 1] & 0x3F)
    kind[lead] = kind[lead + 1] = _CLASS[code]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    joined = np.zeros(n, bool)  # a single blank joins the word after it
    joined[1:] = (data[:-1] == 0x20) & ~first[1:n]
    start = run & (space | ~joined) | first[:n]
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    # The endings that split off with their apostrophe.
    singles, doubles = b"stmd", (b"re", b"ve", b"ll")
    at = np.flatnonzero((data[:-1] == 0x27) & start[:-1] & run[:-1] & run[1:] & (kind[1:] == _LETTER) & ~first[1:n])
    for q in at:
        size = 1 if data[q + 1] in singles else 2 if data[q + 1:q + 3].tobytes() in doubles and not first[q + 2] else 0
        if size:
            start[q + 1] = False
            if q + 1 + size < n:
                start[q + 1 + size] = True
    return np.flatnonzero(start)


def encoder_of(vocabulary: str) -> Encoder:
    """The encoder of this process. Functions reach it by value, so it is kept where every task finds it."""
    kept = vars(sys).setdefault("_stationhour_encoders", {})
    if vocabulary not in kept:
        kept[vocabulary] = Encoder(vocabulary)
    return kept[vocabulary]


class Encoder:
    """Token ids of documents; words seen before in this task are looked up.

    The ids are those of ``tokenizers`` with the given vocabulary file. Where ids are the ranks of the merges, as in that
    family of files, single words are merged by ``tiktoken`` from the same vocabulary, which gives the same ids in less time.
    """

    def __init__(self, vocabulary: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.keep = keep
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a sentence or a line
        self.ends[[i for t, i in vocab.items() if t.endswith((".", "!", "?")) or "Ċ" in t]] = True
        self.words = self._ranked(vocabulary) or (lambda words: self._whole([w.decode() for w in words]))
        self.forget()

    def _ranked(self, vocabulary: str):
        import tiktoken

        model = json.loads(Path(vocabulary).read_text())["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        vocab = model["vocab"]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        # byte-level alphabet: printable bytes stand for themselves, the rest are shifted past 255 in order
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        last = 256 + len(model["merges"])
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i < last}
        merge = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda words: [merge(w.decode()) for w in words]

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)   # sorted hashes of words
        self.number = np.empty(0, np.int64)   # their numbers
        self.flat = np.empty(0, np.uint32)    # ids of word 0, of word 1, ...
        self.at = np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = pieces(data, bounds) if len(data) else np.empty(0, np.int64)
        end = np.append(start[1:], len(data))[:len(start)]
        hashes, example, which = np.unique(V.Rolling(V.byte_values(data)).of(start, end), return_index=True, return_inverse=True)
        if len(self.known) > self.keep:
            self.forget()
        place = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        if len(self.known):
            new = self.known[np.minimum(place, len(self.known) - 1)] != hashes
        if new.any():
            raw = data.tobytes()
            first = example[new]
            got = self.words([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)])
            self.known = np.insert(self.known, place[new], hashes[new])
            self.number = np.insert(self.number, place[new], len(self.at) - 1 + np.arange(len(got)))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(got), np.uint32)])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(ids) for ids in got])])
        number = self.number[np.searchsorted(self.known, hashes)][which]
        size = np.diff(self.at)[number]
        ids = self.flat[V.ragged(self.at[number], size)]
        token = np.concatenate([[0], np.cumsum(size)])
        return ids, token[np.searchsorted(start, bounds)]

    def documents(self, data: np.ndarray, bounds: np.ndarray, last: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of all documents of a slice, each ended by the id ``last``."""
        plain = _plain(data, bounds)
        change = np.concatenate([[0], np.flatnonzero(plain[1:] != plain[:-1]) + 1, [len(plain)]])
        ids, counts = [], []
        for a, b in zip(change[:-1], change[1:], strict=True):
            part = data[bounds[a]:bounds[b]]
            if plain[a]:
                own, at = self._plain(part, bounds[a:b + 1] - bounds[a])
            else:
                raw = part.tobytes()
                own = self._whole([raw[x:y].decode() for x, y in zip(bounds[a:b] - bounds[a], bounds[a + 1:b + 1] - bounds[a], strict=True)])
                at = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                own = np.array([x for doc in own for x in doc], np.uint32)
            ids.append(np.insert(own, at[1:], last))
            counts.append(np.diff(at) + 1)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def choose_windows(ends: np.ndarray, penalty: np.ndarray, size: int = 1024, cut: float = 4.0, reach: int = 2) -> np.ndarray:
    """Window bounds from 0 to ``ends[-1]`` that minimise padding plus penalties.

    ``ends`` are the positions where a window may end without a cut inside a sentence, increasing, ``penalty`` what ending
    there costs. Between two chosen ends lie up to ``reach`` windows: all but the last are
    full and cost ``cut`` each, the last is padded. Gaps longer than a window get ends of their own.
    """
    gap = np.diff(np.concatenate([[0], ends]))
    if (gap > size).any():
        wide = np.flatnonzero(gap > size)
        more = np.concatenate([np.arange(ends[i] - gap[i] + size, ends[i], size) for i in wide])
        ends, penalty = np.concatenate([ends, more]), np.concatenate([penalty, np.full(len(more), cut)])
        order = np.argsort(ends, kind="stable")
        ends, penalty = ends[order], penalty[order]
    position = [0, *ends.tolist()]
    charge = [0.0, *penalty.tolist()]
    best, back, key = [0.0], [0], [0.0]
    queues = [deque() for _ in range(reach)]
    entered = [0] * reach
    for i in range(1, len(position)):
        p = position[i]
        found, origin = float("inf"), 0
        for k, queue in enumerate(queues):
            high, low = p - size * k, p - size * (k + 1)
            j = entered[k]
            while j < i and position[j] < high:
                value = key[j]
                while queue and key[queue[-1]] >= value:
                    queue.pop()
                queue.append(j)
                j += 1
            entered[k] = j
            while queue and position[queue[0]] < low:
                queue.popleft()
            if queue:
                cost = key[queue[0]] - low + k * cut
                if cost < found:
                    found, origin = cost, queue[0]
        best.append(found + charge[i])
        key.append(best[i] + p)
        back.append(origin)
    out, i = [], len(position) - 1
    while i:
        j = back[i]
        out.append(position[i])
        out.extend(range(position[j] + size * ((position[i] - position[j] - 1) // size), position[j], -size))
        i = j
    return np.array([0, *reversed(out)], np.int64)


def _spaced(ends: np.ndarray, spacing: int) -> np.ndarray:
    """The first end in each stretch of ``spacing`` tokens."""
    stretch = ends // spacing
    return ends[np.append(True, stretch[1:] != stretch[:-1])[:len(ends)]]


def _tail(bounds: np.ndarray, size: int) -> np.ndarray:
    """Split a short last window into powers of two, which need no padding."""
    rest = int(bounds[-1] - bounds[-2]) if len(bounds) > 1 else size
    if rest == size:
        return bounds
    steps = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.concatenate([bounds[:-1], bounds[-2] + np.cumsum(steps)])


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, cut: float = 4.0, sentence: float = 0.5,
         spacing: int = 24, with_ids: bool = False, text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens (a power of two).

    A document is its ids and the id 0. Each id lies in one piece; the pieces of a sequence follow the order of
    the documents and leave no gap. A sequence is padded to ``size`` unless its length is a power of two.
    ``cut`` and ``sentence`` are what cutting inside a sentence and at a sentence's end costs, in padding tokens; of
    sentence ends, the first in each ``spacing`` tokens is a candidate, of document ends all. Null and empty
    texts are the id 0 alone; texts of any length are cut as often as needed; repeated rows and null ids are documents like any
    other. Only doc_id and text are read. ``with_ids`` adds the ids of each piece as an array.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for a, b, data, bounds in V.slices(table, "text"):
                ids, at = encoder.documents(data, bounds)
                ends = np.union1d(_spaced(np.flatnonzero(encoder.ends[ids]) + 1, spacing), at[1:])
                charge = np.full(len(ends), sentence)
                charge[np.searchsorted(ends, at[1:])] = 0.0
                windows = _tail(choose_windows(ends, charge, size, cut), size)
                start = np.union1d(windows, at)[:-1]
                end = np.append(start[1:], at[-1])
                doc = np.searchsorted(at, start, "right") - 1
                window = np.searchsorted(windows, start, "right") - 1
                length = np.diff(windows)
                padded = np.where((length & (length - 1)) == 0, length, size)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(start.tolist(), end.tolist(), strict=True)]
                columns = [table.column("doc_id").slice(a, b - a).take(pa.array(doc)).combine_chunks(), pa.array(start - at[doc]),
                           pa.array(end - start), pa.array(crc, pa.int64()), pa.array(np.diff(at)[doc]),
                           pa.array(sequence + window), pa.array(start - windows[window]), pa.array(padded[window])]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(start, at[-1]).astype(np.int32), pa.array(ids.astype(np.int32))))
                sequence += len(windows) - 1
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", f"`{text}` as text").mapInArrow(run, schema)
