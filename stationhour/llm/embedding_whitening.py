"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of their centred rows.

The distinct rows are written once, as blocks of whole numbers. A step of the bidiagonalisation is one pass over the blocks: with the
centred rows X, each block multiplies its rows by a vector (``w = X p``), and the transpose by what came out (``X' w``); sums of d numbers reach the
driver. The left vectors u, as long as the table, are never stored or gathered: each is X times a known vector y of d numbers, and is multiplied out
anew where it is needed. Every new right vector is orthogonalised against all earlier ones, every new left vector likewise through the y's, and
where that removes more than rounding the pass is repeated. The singular value decomposition of the small bidiagonal matrix on the driver
gives components and deviations.

Blocks are read back from storage, so a lost executor repeats a pass over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stationhour.llm.staging import free_name
from stationhour.session import write_shared

BLOCK_BYTES = 1 << 20
TASK_BYTES = 8 << 20  # of distinct rows in a task of a pass; more where that would make over MOST_TASKS
MOST_TASKS = 4096
_EXACT = 1 << 62  # sums of squares are 64-bit numbers below this estimate
_ROUNDING = 1e-12


def whole_numbers(vectors: pa.Array, dims: int, scale: float, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that hold ``dims`` finite numbers, ``floor(scale * c) + shift`` of their entries)."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == dims)
    entries = vectors.take(pa.array(at)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(entries).all(axis=1)
    scaled = np.floor(scale * entries[finite])
    return at[finite], np.clip(scaled, -2.0 ** 62, 2.0 ** 62).astype(np.int64) + shift


def _pack(rows: np.ndarray) -> list[bytes]:
    """Bytes of each row, half as many where its entries allow; equal rows give equal bytes."""
    narrow = ((rows >= -1 << 31) & (rows < 1 << 31)).all(axis=1)
    return [(r.astype("<i4") if n else r.astype("<i8")).tobytes() for r, n in zip(rows, narrow, strict=True)]


@dataclass(frozen=True)
class FitList:
    """Distinct rows in blocks, their number and the sums of their dimensions."""
    blocks: DataFrame
    dims: int
    n: int
    sums: np.ndarray  # Python integers


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length, of equally frequent ones the largest."""
    found = (vectors.select(F.size("v").alias("d")).filter("d > 0").groupBy("d").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("d")).first())
    return found.d if found else 1  # no vector has it


def fit_list(vectors: DataFrame, scale: float, shift: int) -> FitList:
    """Each distinct row of the column ``v`` once."""
    dims = _dimension(vectors)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = whole_numbers(batch.column(0), dims, scale, shift)
            yield pa.RecordBatch.from_arrays([pa.array(_pack(rows), pa.binary())], names=["x"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {4: [], 8: []}
        for batch in batches:
            for x in batch.column(0).to_pylist():
                own = held[len(x) // dims]
                own.append(x)
                if len(own) * len(x) >= BLOCK_BYTES:
                    yield emit(len(x) // dims, own)
                    own.clear()
        for width, own in held.items():
            if own:
                yield emit(width, own)

    def emit(width: int, rows: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([b"".join(rows)], pa.large_binary())], names=["width", "rows"])

    # the tasks of a pass follow from the bytes, not from how the table was dealt
    distinct = write_shared(vectors.mapInArrow(pack, "x binary").distinct(), "whitening_rows")
    total = distinct.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    tasks = min(MOST_TASKS, 1 + total // TASK_BYTES)
    blocks = write_shared(distinct.coalesce(tasks).mapInArrow(block, "width int, rows binary"), "whitening_blocks")

    def add(x: np.ndarray) -> dict[str, np.ndarray]:
        return {"s": x.astype(object).sum(axis=0) if _large(x) else x.sum(axis=0).astype(object), "n": np.array([len(x)], object)}

    out = _summed(blocks, dims, add, exact=True)
    return FitList(blocks, dims, int(out["n"][0]) if out else 0, np.array([int(v) for v in out["s"]], object) if out else np.zeros(dims, object))


def _large(x: np.ndarray) -> bool:
    return bool(len(x)) and float(np.abs(x.astype(np.float64)).max()) * len(x) >= _EXACT


def _rows(width: int, data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<i4" if width == 4 else "<i8").reshape(-1, dims).astype(np.int64)


def _summed(blocks: DataFrame, dims: int, of: Callable[[np.ndarray], dict[str, np.ndarray]], exact: bool = False) -> dict[str, np.ndarray]:
    """Sums over all blocks of what ``of`` says of one block, added up in each task and then over the tasks; ``exact`` for whole numbers."""
    kind = "string" if exact else "double"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for width, data in zip(batch.column(0), batch.column(1), strict=True):
                for name, values in of(_rows(width.as_py(), data.as_py(), dims)).items():
                    total[name] = total[name] + values if name in total else values
        for name, values in total.items():
            flat = [str(v) for v in values] if exact else values.tolist()
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(flat)), pa.array(range(len(flat)), pa.int32()),
                                              pa.array(flat, pa.string() if exact else pa.float64())], names=["name", "place", "value"])

    rows = blocks.mapInArrow(each, f"name string, place int, value {kind}")
    value = F.sum(F.col("value").cast("decimal(38,0)")) if exact else F.sum("value")
    found: dict[str, dict[int, object]] = {}
    for r in rows.groupBy("name", "place").agg(value.alias("value")).collect():
        found.setdefault(r.name, {})[r.place] = r.value
    return {name: np.array([values[i] for i in range(len(values))], object if exact else np.float64) for name, values in found.items()}


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact, divided by n."""
    return _spread(x, n, sums).astype(np.float64) / n


def _spread(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` in 64 bits, or as Python integers where those do not suffice."""
    most = max(float(np.abs(x.astype(np.float64)).max(initial=0)) * n, float(max(map(abs, sums), default=0)))
    if most < _EXACT:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


@dataclass(frozen=True)
class Components:
    """Unit vectors in the columns of ``vectors`` by falling ``values``, which are eigenvalues of the covariance; ``trace`` is that matrix's."""
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def _orthogonal(z: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in basis:
            z = z - v * (v @ z)
    return z


def bidiagonalise(fit: FitList, steps: int | None = None, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(B, V) with ``X V = U B``: B upper bidiagonal, V and the unseen U of orthonormal columns. Without ``steps`` the space is exhausted, so
    that equal singular values are all found; where a recurrence ends before, it goes on with a vector orthogonal to all so far."""
    n, sums, dims = fit.n, fit.sums, fit.dims

    def products(p: np.ndarray) -> tuple[np.ndarray, float]:
        """``X'(X p)`` and the squared length of ``X p``."""
        def of(x: np.ndarray) -> dict[str, np.ndarray]:
            rows = _centred(x, n, sums)
            w = rows @ p
            return {"t": rows.T @ w, "square": np.array([w @ w])}
        found = _summed(fit.blocks, dims, of)
        return found["t"], float(found["square"][0])

    rng = np.random.default_rng(seed)
    most = min(dims, steps or dims)
    right: list[np.ndarray] = []
    left: list[np.ndarray] = []  # y: the left vector is X y
    transposed: list[np.ndarray] = []  # X' u
    alphas, betas, largest = [], [], 0.0
    v, beta = rng.standard_normal(dims), 0.0
    v /= np.linalg.norm(v)
    while len(right) < most:
        p = v - beta * left[-1] if left and beta else v
        t, square = products(p)
        removed = np.array([y @ t for y in left])  # u'w of all earlier left vectors
        if left and np.abs(removed).max() > _ROUNDING * np.sqrt(square):
            p = p - np.array(left).T @ removed
            t, square = products(p)
        alpha = float(np.sqrt(square))
        largest = max(largest, alpha, beta)
        right.append(v)
        if alpha <= _ROUNDING * largest or alpha == 0:  # a direction without spread
            alpha, y, g = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            y, g = p / alpha, t / alpha
        left.append(y)
        transposed.append(g)
        alphas.append(alpha)
        if len(right) == most:
            break
        z = _orthogonal(g - alpha * v, right)
        beta = float(np.linalg.norm(z))
        if beta <= _ROUNDING * largest or beta == 0:
            z, beta = _orthogonal(rng.standard_normal(dims), right), 0.0
            v = z / np.linalg.norm(z)
        else:
            v = z / beta
        betas.append(beta)
    size = len(right)
    small = np.diag(alphas) + np.diag(betas, 1) if size > 1 else np.diag(alphas)
    return small, np.array(right).T.reshape(dims, size)


def components(fit: FitList, count: int, steps: int | None = None) -> Components:
    """The ``count`` components of largest eigenvalue, or as many as have any spread."""
    n, sums, dims = fit.n, fit.sums, fit.dims
    if not n:
        return Components(np.zeros((dims, 0)), np.zeros(0), 0.0, 0.0)
    small, right = bidiagonalise(fit, steps)
    _, sigma, turned = np.linalg.svd(small)
    keep = [i for i in range(len(sigma))[:count] if sigma[i] > 0 and sigma[i] > 1e-10 * sigma[0]]
    vectors, values = (right @ turned.T)[:, keep], sigma[keep] ** 2 / n
    vectors = vectors / np.linalg.norm(vectors, axis=0) if len(keep) else vectors
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(len(keep))] < 0, -1.0, 1.0) if len(keep) else vectors

    def of(x: np.ndarray) -> dict[str, np.ndarray]:
        rows = _centred(x, n, sums)
        white = rows @ vectors / np.sqrt(values)
        return {"trace": np.array([(rows * rows).sum()]), "mean": white.sum(axis=0), "white": (white.T @ white).ravel()}

    if not keep:
        return Components(vectors, values, 0.0, 0.0)
    found, k = _summed(fit.blocks, dims, of), len(keep)
    mean = found["mean"] / n
    spread = found["white"].reshape(k, k) / n - np.outer(mean, mean)
    return Components(vectors, values, float(found["trace"][0]) / n, float(np.abs(spread - np.eye(k)).max(initial=0.0)))


def whiten(rows: DataFrame, count: int = 16, vector: str = "embedding", scale: float = 64.0, shift: int = 1_000_000, steps: int | None = None) -> DataFrame:
    """For each row that remains and each component: the columns of ``rows`` but the vector, with component (int, from 1 by falling eigenvalue),
    n (distinct vectors), deviation (long), whitened, explained, identity_error (doubles).

    Entries become whole numbers ``floor(scale * c) + shift``; components are those of the distinct vectors' covariance (divisor n). ``deviation`` is the sum over the
    dimensions of ``(n * x - S) ** 2``, exact, null beyond a long. ``whitened`` is the centred vector's projection over the component's deviation. Of a component's two
    signs, the entry of largest size is positive.

    Rows are dropped whose vector is null, empty, holds null or non-finite entries, or is not of the most frequent length (of equally frequent ones the
    longest). Repeated vectors count once in the fit and are returned for each row. Components without spread are left out: equal vectors alone, and empty tables,
    give no rows. Input columns of the result's names are replaced.
    """
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = [c for c in rows.columns if c != vector and c.lower() not in added]
    vectors = rows.select(F.col(vector).cast("array<double>").alias("v"))
    fit = fit_list(vectors, scale, shift)
    found = components(fit, count, steps)
    dims, n, sums, k = fit.dims, fit.n, fit.sums, len(found.values)
    explained = [float(e / found.trace) for e in found.values]
    whitener = found.vectors / np.sqrt(found.values)
    results = pa.schema([("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                         ("explained", pa.float64()), ("identity_error", pa.float64())])

    def squares(spread: np.ndarray) -> list[int | None]:
        if spread.dtype != object and float((spread.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < _EXACT:
            return (spread * spread).sum(axis=1).tolist()
        exact = [sum(int(c) ** 2 for c in row) for row in spread]
        return [s if s < 1 << 63 else None for s in exact]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = whole_numbers(batch.column(len(kept)), dims, scale, shift)
            if not len(at) or not k:
                continue
            spread = _spread(x, n, sums)
            white = (spread.astype(np.float64) / n) @ whitener
            carried = [batch.column(i).take(pa.array(np.repeat(at, k))) for i in range(len(kept))]
            m = len(at)
            values = [np.tile(np.arange(1, k + 1), m), np.full(m * k, n), [d for d in squares(spread) for _ in range(k)], white.ravel(),
                      np.tile(explained, m), np.full(m * k, found.identity_error)]
            yield pa.RecordBatch.from_arrays(carried + [pa.array(v, f.type) for v, f in zip(values, results, strict=True)], names=out_names)

    out_names = kept + results.names
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema] +
                       ["component int, n long, deviation long, whitened double, explained double, identity_error double"])
    return rows.select(*kept, F.col(vector).cast("array<double>").alias(free_name(kept, "v"))).mapInArrow(project, fields)
