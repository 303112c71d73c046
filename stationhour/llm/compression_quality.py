"""Quality score from compression: two zstandard dictionaries, one of good and one of bad labelled text.

A text is compressed block by block with either dictionary; the difference of the two sizes over its length says which
kind of text explains it better. A logistic fit on the labels turns that into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from stationhour.session import write_shared


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    block: int
    level: int

    def compressors(self):
        out = []
        for raw in (self.bad, self.good):
            if not raw:
                out.append(zstandard.ZstdCompressor(level=self.level))
                continue
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(level=self.level)
            out.append(zstandard.ZstdCompressor(dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out


def _blocks(text: bytes, block: int) -> list[bytes]:
    return [text[i:i + block] for i in range(0, len(text), block)]


def difference(texts: list[bytes], compressors, block: int) -> np.ndarray:
    """Size with the bad dictionary less size with the good one, over the length; 0 for an empty text."""
    bad, good = (c.compress for c in compressors)
    return np.array([sum(len(bad(x)) - len(good(x)) for x in _blocks(t, block)) / (len(t) + 50) for t in texts])


def _dictionary(texts: list[bytes], block: int, size: int) -> bytes:
    samples = [x for t in texts for x in _blocks(t, block) if len(x) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to train on: their raw content serves
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit by Newton's method, with a small penalty on the slope."""
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + np.array([1e-2 * w[0], 0])
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-9])
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, dictionary: int = 112 << 10, block: int = 2048,
        level: int = 3, sample_bytes: int = 24 << 20) -> Model:
    """Learn from at most ``per_class`` labelled rows of each class, held-out rows left out.

    The sample is the rows with the smallest hashes of their ids, of whole texts, up to ``sample_bytes`` of text a class; a text that does
    not fit any more is passed over. Of a repeated id one text counts. Half
    of them make the dictionaries, the other half the calibration, so that a dictionary never scores its own text.
    Rows without a label, id or text are no use here. Without rows of both classes every score is 0.5.
    """
    texts = {}
    for label in (0, 1):
        order = F.xxhash64(F.lit(label), "doc_id")
        chosen = (labels.filter((F.col("quality") == label) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id").distinct()
                  .orderBy(order, "doc_id").limit(per_class))
        # one text of an id, however often the id is repeated
        rows = write_shared(docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).filter("text IS NOT NULL"), "labelled_texts")
        picked, left = [], sample_bytes
        for r in rows.select(order.alias("h"), "doc_id", F.octet_length("text").alias("size")).orderBy("h", "doc_id").collect():  # numbers, per_class at most
            if r["size"] <= left:
                picked.append((len(picked), r.doc_id))
                left -= r["size"]
        places = docs.sparkSession.createDataFrame(picked, f"place int, doc_id {docs.schema['doc_id'].dataType.simpleString()}")
        texts[label] = [r.text.encode() for r in rows.join(F.broadcast(places), "doc_id").orderBy("place").select("text").collect()]
    bad, good = texts[0], texts[1]
    if len(bad) < 2 or len(good) < 2:
        return Model(b"", b"", 0.0, 0.0, block, level)
    model = Model(_dictionary(good[::2], block, dictionary), _dictionary(bad[::2], block, dictionary), 0.0, 0.0, block, level)
    x = difference(bad[1::2] + good[1::2], model.compressors(), block)
    y = np.array([0.0] * len(bad[1::2]) + [1.0] * len(good[1::2]))
    slope, offset = _logistic(x, y)
    return Model(model.good, model.bad, slope, offset, block, level)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row, from its whole text alone.

    Null and empty texts have difference 0; repeated rows and null ids are scored like any other. Columns other than
    doc_id and text are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
            x = difference(texts, compressors, model.block)
            p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Fit and score: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from 0.5 up)."""
    return score(docs, fit(docs, labels, **settings)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
