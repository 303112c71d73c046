"""Quality rules: base counts of every text, then a likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed grams of four bytes: trusted target text against the raw
corpus. Its mean over a text's grams is compared with a fixed threshold, so the verdict on a text never depends on chance.
The corpus counts cover every document, target and threshold every trusted one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stationhour.functions.quantiles import refined_quantiles, value_counts
from stationhour.llm import vectors as V
from stationhour.session import write_shared

# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BLOCKS = 64
_SLICE = 1 << 18     # bytes of text looked at together: some forty times as much memory


def _grams(data: np.ndarray, bounds: np.ndarray, buckets: int, size: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every run of ``size`` bytes inside a document."""
    at = np.flatnonzero(V.window_starts(bounds, len(data), size)) if len(data) >= size else np.empty(0, np.int64)
    code = np.zeros(max(0, len(data) - size + 1), np.uint64)
    for i in range(size):
        code = code << np.uint64(8) | data[i:i + len(code)]
    return (V.mix(code[at]) >> np.uint64(32)).astype(np.int64) % buckets, np.searchsorted(bounds, at, "right") - 1


def gram_counts(docs: DataFrame, buckets: int, text: str = "text", part: str | None = None, parts: int = 1) -> np.ndarray:
    """Counts of the hashed grams of all of ``docs``, a row for each of the ``parts`` numbered in the column ``part``. A task adds up its own; the
    sums are of fixed size."""
    wide = -(-buckets // _BLOCKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, wide * _BLOCKS), np.int64)
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False) if part else np.zeros(batch.num_rows, np.int32)
            for a, b, data, bounds in V.slices(pa.Table.from_batches([batch]), text, _SLICE):
                gram, doc = _grams(data, bounds, buckets)
                of = own[a:b][doc]
                for i in np.unique(own[a:b]):
                    total[i] += np.bincount(gram[of == i] if part else gram, minlength=wide * _BLOCKS)
        for i in np.flatnonzero(total.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([i] * _BLOCKS, pa.int32()), pa.array(range(_BLOCKS), pa.int32()),
                                              pa.array([x.tobytes() for x in total[i].reshape(_BLOCKS, -1)], pa.binary())], names=["part", "block", "counts"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "block": [key[1]], "counts": [sum(np.frombuffer(x, np.int64) for x in rows.counts).tobytes()]})

    schema = "part int, block int, counts binary"
    sums = docs.select(text, *[part] * bool(part)).mapInArrow(count, schema).groupBy("part", "block").applyInPandas(add, schema)
    out = np.zeros((parts, _BLOCKS, wide), np.int64)
    for r in sums.collect():  # as many rows as blocks, for each part
        out[r.part, r.block] = np.frombuffer(r.counts, np.int64)
    return out.reshape(parts, -1)[:, :buckets]


@dataclass(frozen=True)
class Ratio:
    weights: bytes      # log ratio of every bucket, float32: against the whole target, then against the target without each of its parts
    parts: int
    shrink: float

    def of(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return total / (n + self.shrink)


def _part(parts: int, key: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(F.lit(9), key), F.lit(parts)).cast("int")


def trusted_ids(trusted: DataFrame) -> DataFrame:
    return trusted.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = 1 << 16, prior: float = 0.2, shrink: float = 20.0, parts: int = 5) -> Ratio:
    """Log ratios of the target against the corpus.

    ``trusted`` names trusted documents; all of them make the target. It is mixed with the
    corpus at the weight ``prior``, so that a gram the target lacks costs at most its logarithm. For the threshold, the target is also taken
    without each of ``parts`` equal parts of it. Without trusted documents all ratios are 0.
    """
    # the ids are hashed, the texts pass by them unsorted
    good = docs.select("doc_id", "text").join(trusted_ids(trusted).hint("shuffle_hash"), "doc_id", "left_semi")
    raw, each = gram_counts(docs, buckets)[0], gram_counts(good.select("text", _part(parts).alias("part")), buckets, part="part", parts=parts)
    base = (raw + 0.5) / (raw.sum() + 0.5 * buckets)

    def weights(target: np.ndarray) -> np.ndarray:
        return np.log((1 - prior) * target / target.sum() / base + prior) if target.sum() else np.zeros(buckets)

    whole = each.sum(axis=0)
    return Ratio(np.stack([weights(x) for x in (whole, *(whole - each))]).astype(np.float32).tobytes(), parts, shrink)


def threshold(measured: DataFrame, trusted: DataFrame, lost: float = 0.002, margin: float = 0.05) -> float:
    """``margin`` below the ratio that ``lost`` of all trusted texts do not reach, each against the target without its own part; an exact quantile."""
    own = measured.join(trusted_ids(trusted), "doc_id", "left_semi").withColumn("of", F.lit("trusted"))
    found = refined_quantiles(value_counts(own, ["of"], {"unseen": F.col("unseen")}), ["of"], {"least": ("unseen", lost)}).first()
    return min(0.0, found.least if found else -1.0) - margin


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_doc(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by document and key, is each equal to the one before it)."""
    order = np.lexsort((key, doc))
    same = np.zeros(len(order), bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return order, same


def base_counts(data: np.ndarray, bounds: np.ndarray, window: int = 5) -> list[np.ndarray]:
    start, end, at = V.words(data, bounds)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = _per_doc(points[end] - points[start], at)
    # lines with a word, equal to an earlier one of their document
    breaks = np.union1d(np.flatnonzero(data == 10) + 1, bounds[:-1])
    breaks = breaks[breaks < len(data)]
    stop = np.minimum(np.append(breaks[1:], len(data)), len(data))
    stop = stop - ((stop > breaks) & (data[np.maximum(stop - 1, 0)] == 10) if len(data) else 0)
    has = np.searchsorted(start, stop) > np.searchsorted(start, breaks)
    breaks, stop = breaks[has], stop[has]
    own = np.searchsorted(bounds, breaks, "right") - 1
    order, same = _repeated(V.Rolling(V.byte_values(data)).of(breaks, stop), own)
    lines = np.bincount(own[order[same]], minlength=len(bounds) - 1)
    # words in windows found twice or more in their document
    tokens = V.word_hashes(data, start, end)
    first = np.flatnonzero(V.window_starts(at, len(tokens), window))
    doc = np.searchsorted(at, first, "right") - 1
    order, same = _repeated(V.Rolling(tokens).all(window)[first], doc)
    twice = same.copy()
    twice[:-1] |= same[1:]
    change = np.zeros(len(tokens) + 1, np.int32)
    hit = first[order[twice]]
    change[hit] += 1
    change[hit + window] -= 1
    words = _per_doc(np.cumsum(change[:-1]) > 0, at)
    return [np.diff(at), chars, _per_doc(_SYMBOL[data], bounds), lines, words]


def measure(docs: DataFrame, model: Ratio, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, the base counts, the ratio of every row, and its ratio against the target without the row's part."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", ratio double, unseen double"
    names = [key, *_COUNTS, "ratio", "unseen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(model.weights, np.float32).reshape(model.parts + 1, -1)
        for batch in batches:
            part = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b, data, bounds in V.slices(pa.Table.from_batches([batch]), text, _SLICE):
                counts = base_counts(data, bounds)
                gram, doc = _grams(data, bounds, weights.shape[1])
                n = np.bincount(doc, minlength=b - a)
                ratios = [model.of(np.bincount(doc, weights=w, minlength=b - a), n) for w in (weights[0, gram], weights[1 + part[a:b][doc], gram])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x.astype(np.int64)) for x in counts), *map(pa.array, ratios)],
                                                 names=names)

    return docs.select(key, text, _part(model.parts, key).alias("part")).mapInArrow(run, schema)


def apply_rules(docs: DataFrame, trusted: DataFrame, min_words: int = 10, max_repeat: int = 20, lost: float = 0.002, margin: float = 0.05,
                **settings) -> DataFrame:
    """doc_id, base counts, ratio, base_failed and kept of every row of ``docs``.

    Null and empty texts have no words and fail the base rules. A text passes with at least ``min_words`` words, at most
    ``max_repeat`` per cent of them in repeated windows, and a ratio not below the threshold. Repeated rows and null ids are judged like
    any other; columns other than doc_id and text are not read.
    """
    measured = write_shared(measure(docs, fit(docs, trusted, **settings)), "quality-measures")  # a few numbers a row
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return (measured.drop("unseen").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold(measured, trusted, lost, margin))))
