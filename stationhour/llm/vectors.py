"""Vectorised text helpers for Arrow batches: words, rolling hashes, window anchors.

All functions work on a *slice*: the concatenated UTF-8 bytes of some whole documents and the
``bounds`` between them (``len(documents) + 1`` positions). Null texts are empty documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_POSITION_BITS = np.uint64(28)
_POSITION = np.uint64((1 << 28) - 1)
_U = np.uint64

_rng = np.random.default_rng(20240501)
_BYTE_VALUES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def power(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of an odd base, or of its inverse, modulo 2**64."""
    known = _powers.get((which, inverse))
    if known is None or len(known) < n:
        base = pow(_BASES[which], -1, 1 << 64) if inverse else _BASES[which]
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        _powers[which, inverse] = known = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place on a new array)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def slices(table: pa.Table, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, bounds): whole rows, about ``limit`` bytes at a time."""
    first = 0
    for chunk in table.column(column).chunks:
        if not len(chunk):
            continue
        text = chunk.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        row = 0
        while row < len(text):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield first + row, first + end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
            row = end
        first += len(text)


# The bytes that separate words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word bounds): byte spans of all words, and each document's part of them."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = inside[0]
    np.not_equal(inside[1:], inside[:-1], out=change[1:])
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    touching = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    edges = np.flatnonzero(change)
    start, end = edges[0::2], edges[1::2]
    if len(touching):  # a word of one document directly followed by one of the next
        start, end = np.sort(np.concatenate([start, touching])), np.sort(np.concatenate([end, touching]))
    return start, end, np.searchsorted(start, bounds)


class Rolling:
    """Hashes of any substrings of a sequence, from one cumulative sum."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.which = which
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power(which, n), out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = power(self.which, len(self.total), True)
        return mix((self.total[end] - self.total[start]) * inverse[start] + (end - start).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of the substring of ``length`` at each position."""
        n = max(0, len(self.total) - length)
        return mix((self.total[length:length + n] - self.total[:n]) * power(self.which, n, True))


def byte_values(data: np.ndarray, which: int = 0) -> np.ndarray:
    return _BYTE_VALUES[which][data]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return Rolling(byte_values(data, which), which).of(start, end)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def window_starts(bounds: np.ndarray, n: int, length: int) -> np.ndarray:
    """For each position up to ``n - length``: does a window from here stay in one document?"""
    valid = np.ones(max(0, n - length + 1), bool)
    if len(valid):
        for back in range(1, length):  # a bound strictly inside the window spoils it
            at = bounds[1:-1] - back
            valid[at[(at >= 0) & (at < len(valid))]] = False
    return valid


def segments(grams: np.ndarray, bounds: np.ndarray, n: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Group all windows of ``length`` tokens by the gram inside them whose hash is smallest.

    Equal windows have their anchor at the same offset, so they meet under the same anchor hash.
    Returns (first window, last window, anchor position) of each group; its windows are
    consecutive, at most ``length - gram + 1``, and each window is in exactly one group.
    """
    if n < length:
        return (np.empty(0, np.int64),) * 3
    keyed = (grams >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(keyed, length - gram + 1) & _POSITION).astype(np.int64)
    valid = window_starts(bounds, n, length)
    at = np.flatnonzero(valid)
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    own = anchor[at]
    new = np.empty(len(at), bool)
    new[0] = True
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], own[first]


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] values), then the same of the next."""
    total = int(size.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    full = size > 0
    start, size = start[full], size[full]
    ends = np.cumsum(size)
    out[0] = start[0]
    out[ends[:-1]] = start[1:] - (start[:-1] + size[:-1]) + 1
    return np.cumsum(out)


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def unpack(blobs, kind) -> np.ndarray:
    """Concatenate packed arrays."""
    return np.frombuffer(b"".join(blobs), kind)


def arrow_strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
