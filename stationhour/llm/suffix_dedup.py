"""Suffix-array dedup over bytes: a radix sort of the suffixes, most significant digit first, that stops at the threshold.

Only the first ``length`` bytes of a suffix matter: suffixes equal through that depth are exactly the
repeated windows, so the full suffix array is never ordered.

* Suffixes are dealt to shards by the anchor of their window, the smallest-hashed gram inside it, which equal windows share; a counting
  pass (32 bits an anchor) leaves out every suffix whose anchor is found once, the bulk of the corpus.
* A shard orders its suffixes by passes over digits of eight bytes, from the first byte on (``radix_groups``). Groups of one leave
  after each pass; the last digit ends at the threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stationhour.llm import vectors as V
from stationhour.llm.repeats import Tokens, Windows, cover, repeated_spans
from stationhour.llm.staging import stage

RESULT = "n_bytes long, n_removed long, n_spans long, kept_bytes binary"


def _tokens(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    return Tokens(V.byte_values(data), bounds, data, bounds)


def _eights(data: np.ndarray, length: int) -> tuple[np.ndarray, list[int]]:
    """The eight bytes from each position as one number, and the steps that cover ``length`` bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    value = np.zeros(len(data), np.uint64)
    for i in range(min(8, length)):
        value = value << np.uint64(8) | padded[i:i + len(data)]
    steps = [*range(0, max(1, length - 7), 8)]
    return value, steps if length < 8 or steps[-1] == length - 8 else [*steps, length - 8]


def radix_groups(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Rank the suffixes at positions ``at`` by their first ``length`` bytes, in the order of the bytes; equal ones have one rank.

    The first pass orders all suffixes by their first eight bytes, the most significant digit. Every further pass takes the groups of
    several suffixes and the next eight bytes; groups that these tell apart are ordered by them, groups of one leave. After the
    last digit the groups left are the repeated windows.
    """
    eights, steps = _eights(data, length)
    digit = eights[at]
    by = np.argsort(digit, kind="stable")
    digit = digit[by]
    new = np.ones(len(by) + 1, bool)  # first places of groups, in order; the end is one
    new[1:-1] = digit[1:] != digit[:-1]
    open_ = np.flatnonzero(~(new[:-1] & new[1:]))
    for step in steps[1:]:
        if not len(open_):
            break
        digit, first = eights[at[by[open_]] + step], new[open_]
        apart = np.zeros(len(open_), bool)
        apart[1:] = ~first[1:] & (digit[1:] != digit[:-1])
        if apart.any():
            group = np.cumsum(first) - 1
            mixed = np.zeros(int(group[-1]) + 1, bool)
            mixed[group[apart]] = True
            own = np.flatnonzero(mixed[group])
            order = np.lexsort((digit[own], group[own]))
            by[open_[own]], digit[own] = by[open_[own[order]]], digit[own[order]]
            new[open_[1:]] |= ~first[1:] & (digit[1:] != digit[:-1])
            open_ = open_[~(new[open_] & new[open_ + 1])]
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(new[:-1]) - 1
    return out


def byte_windows(length: int = 50, gram: int | None = None) -> Windows:
    gram = gram or max(1, length - 26)

    def payload(tokens: Tokens, first: np.ndarray, last: np.ndarray):
        size = last - first + length
        return tokens.data[V.ragged(first, size)], size

    def groups(payload: np.ndarray, size: np.ndarray) -> np.ndarray:
        start = np.concatenate([[0], np.cumsum(size + length - 1)])[:-1]
        return radix_groups(payload, V.ragged(start, size), length)

    return Windows(length, gram, _tokens, payload, groups)


def _finish(tokens: Tokens, removed: np.ndarray) -> list[pa.Array]:
    bounds = tokens.bounds
    gone = np.concatenate([[0], np.cumsum(removed)])
    first = removed.copy()  # first bytes of removed runs; a document's first byte starts its own
    first[1:] &= ~removed[:-1]
    begins = bounds[:-1][np.diff(bounds) > 0]
    first[begins] = removed[begins]
    runs = np.concatenate([[0], np.cumsum(first)])
    kept = np.concatenate([[0], np.cumsum(~removed)])[bounds].astype(np.int32)
    data = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(kept), pa.py_buffer(tokens.data[~removed])])
    return [pa.array(np.diff(bounds).astype(np.int64)), pa.array((gone[bounds[1:]] - gone[bounds[:-1]]).astype(np.int64)),
            pa.array((runs[bounds[1:]] - runs[bounds[:-1]]).astype(np.int64)), data]


def remove_repeated_bytes(docs: DataFrame, length: int = 50, text: str = "text") -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a smaller document.

    Returns one row per row of ``docs``: all its columns, then n_bytes, n_removed, n_spans (maximal removed
    runs) and kept_bytes. Null and empty texts have no bytes. Rows with equal ids do not remove from one another; rows
    without an id come after all others, and not from one another. Strings never cross documents. A column
    of ``docs`` named like a result column is replaced.
    """
    made = {"n_bytes", "n_removed", "n_spans", "kept_bytes"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in made])
    staged = stage(docs, text)
    kind = byte_windows(length)
    return cover(staged, kind, repeated_spans(staged, kind), RESULT, list(docs.columns), _finish)


def _finish_text(tokens: Tokens, removed: np.ndarray) -> list[pa.Array]:
    kept = _finish(tokens, removed)[3]
    return [pa.array([b.decode("utf-8", "ignore") for b in kept.to_pylist()], pa.string())]


def cut_repeats(docs: DataFrame, length: int = 50, text: str = "text") -> DataFrame:
    """``docs`` with the repeated strings cut from ``text``, all other columns as they are.

    Where a cut splits a character, the rest of that character goes too. Null texts become empty.
    """
    staged = stage(docs, text)
    kind = byte_windows(length)
    columns = [c for c in docs.columns if c != text]
    return cover(staged, kind, repeated_spans(staged, kind), f"`{text}` string", columns, _finish_text).select(*docs.columns)
