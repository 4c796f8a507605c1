"""Whitened leading components of embeddings by Chebyshev-filtered subspace iteration.

Vectors are turned into whole numbers, ``floor(256 * c)``; each distinct one is in the fit list once. The covariance
is never formed: a block of ``BLOCK`` directions Q is multiplied by it in passes over the fit list, each a sum over
tasks of Xᵀ(XQ) with X centred. A Chebyshev polynomial of such passes damps all directions below the smallest value
in the block; then follow QR and Rayleigh-Ritz, until the residuals of the wanted components are certified. Tasks
see blocks of at most ``ROWS`` vectors, the driver one matrix of dimension x ``BLOCK`` a pass.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are left out. The dimension is the
most frequent length (of equally frequent ones the longest) above 0; rows of another length are left out too.
Entries beyond a 64-bit number are held at its limits, and a ``deviation`` beyond it is null. Equal rows and rows
without an id each have results. Components with a variance of at most ``FLAT`` of the whole cannot be whitened and
are left out, so fewer than four remain where the vectors span fewer; an empty or constant table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

COMPONENTS = 4
BLOCK = 16
DEGREE = 8
ROUNDS = 60
ROWS = 4096
TOLERANCE = 2e-14  # residual of a component, relative to the largest variance
ACCEPTED = 1e-11  # residual at which an iteration that no longer improves has reached rounding noise
FLAT = 1e-12


def points(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``id``, ``x``): whole-number vectors of the rows whose entries are all finite."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(v.isNotNull() & finite).select(
        F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda c: F.floor(c * 256)).cast("array<long>").alias("x")
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _packed(x: DataFrame, dim: int) -> DataFrame:
    """Blocks of vectors as binary matrices of the narrowest width."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            every = _matrix(batch.column(0), dim)
            for at in range(0, len(every), ROWS):
                part = every[at : at + ROWS]
                low, high = int(part.min()), int(part.max())
                width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
                yield pa.RecordBatch.from_pydict(
                    {"rows": pa.array([len(part)], pa.int64()), "width": pa.array([width], pa.int32()), "data": pa.array([part.astype(f"<i{width}").tobytes()], pa.binary())}
                )

    return x.mapInArrow(run, "rows long, width int, data binary")


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterator[np.ndarray]:
    for width, data in zip(batch.column(1).to_pylist(), batch.column(2)):
        yield np.frombuffer(data.as_buffer(), f"<i{width}").reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> list[int]:
    """Exact sums per dimension."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for x in _blocks(batch, dim):
                # halves of 32 bits: neither sum of a block can overflow
                high, low = (x.astype(np.int64) >> 32).sum(0), (x.astype(np.int64) & 0xFFFFFFFF).sum(0)
                yield pa.RecordBatch.from_pydict({"i": np.arange(dim, dtype=np.int32), "high": high, "low": low})

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = fit.mapInArrow(run, "i int, high long, low long").groupBy("i").agg(wide("high"), wide("low")).collect()
    return [(int(r.high) << 32) + int(r.low) for r in sorted(sums)]


def summed(fit: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over all blocks of ``part(block)``, a matrix of ``shape``, added up by a shuffle."""
    height, width = shape

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in stream:
            for x in _blocks(batch, dim):
                total += part(x)
        yield pa.RecordBatch.from_pydict({"i": np.arange(height, dtype=np.int32), **{f"y{j}": total[:, j] for j in range(width)}})

    names = [f"y{j}" for j in range(width)]
    rows = fit.mapInArrow(run, "i int, " + ", ".join(f"{y} double" for y in names)).groupBy("i").agg(*(F.sum(y).alias(y) for y in names)).collect()
    out = np.zeros(shape)
    for r in rows:
        out[r.i] = r[1:]
    return out


def leading(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and unit eigenvectors (columns) of the covariance that ``times`` multiplies a block by."""
    width = min(BLOCK, dim)
    wanted = min(wanted, width)
    q = np.linalg.qr(np.random.default_rng(13).standard_normal((dim, width)))[0]
    y = times(q)
    before = np.inf
    for _ in range(ROUNDS):
        values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        top = float(values[0])
        if top <= 0:
            return np.zeros(0), np.zeros((dim, 0))
        residual = float(np.linalg.norm(y[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()) / top
        if residual <= TOLERANCE or residual <= ACCEPTED and residual > before / 2:
            break
        before = residual
        # scaled three-term recurrence: the polynomial stays small on [0, cut] and is 1 near the largest value
        half = max(float(values[-1]), top * 1e-6) / 2
        first = half / (top - half)
        sigma = first
        last, now = q, (y - half * q) * (first / half)
        for _ in range(DEGREE - 1):
            after = 1 / (2 / first - sigma)
            last, now = now, 2 * (times(now) - half * now) * (after / half) - sigma * after * last
            sigma = after
        q = np.linalg.qr(now)[0]
        y = times(q)
    else:
        raise RuntimeError(f"components not certified within {ROUNDS} rounds: residual {residual:.1e}")
    vectors = q[:, :wanted]
    flip = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values[:wanted], vectors * np.where(flip == 0, 1, flip)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n * x - S)**2 per row; None beyond 64 bits."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    most = max(abs(n * low) + max(map(abs, sums)), abs(n * high) + max(map(abs, sums)))
    if most * most * x.shape[1] < 1 << 63:
        return ((x.astype(np.int64) * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = (sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist())
    return [d if d < 1 << 63 else None for d in exact]


RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """(``id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``) per row and component."""
    spark = rows.sparkSession
    every = points(rows, id_col, vector_col).withColumn("id", F.col("id").cast("long"))
    sizes = every.filter(F.size("x") > 0).groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], RESULT)
    dim = sizes["size"]
    every = every.filter(F.size("x") == dim)
    fit = stored(_packed(every.select("x").distinct(), dim), "fit")
    n = fit.agg(F.sum("rows")).first()[0]
    sums = _sums(fit, dim)
    mean = np.array([s / n for s in sums])

    def times(q: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ q)

        return summed(fit, dim, part, q.shape) / n

    values, vectors = leading(times, dim, wanted)
    trace = float(summed(fit, dim, lambda x: ((x - mean) ** 2).sum(0)[:, None], (dim, 1)).sum()) / n
    some = int((values > FLAT * trace).sum())
    if not some:
        return spark.createDataFrame([], RESULT)
    values, white = values[:some], vectors[:, :some] / np.sqrt(values[:some])

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ white
        return np.vstack([z.T @ z, z.sum(0)])

    moment = summed(fit, dim, moments, (some + 1, some)) / n
    error = float(np.abs(moment[:some] - np.outer(moment[some], moment[some]) - np.eye(some)).max())
    share = values / trace

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            x = _matrix(batch.column(1), dim)
            again = np.repeat(np.arange(len(x)), some)
            columns = [
                batch.column(0).take(pa.array(again)),
                pa.array(np.tile(np.arange(1, some + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(again), n, np.int64)),
                pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(again)),
                pa.array(((x - mean) @ white).reshape(-1)),
                pa.array(np.tile(share, len(x))),
                pa.array(np.full(len(again), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return every.mapInArrow(run, RESULT)
