"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of a covariance come from passes over the rows only: each pass multiplies the centred rows' XᵀX with a
block of vectors, task by task, and sums the results by dimension. A Chebyshev polynomial of the covariance, built by its
three-term recurrence from such passes, damps the unwanted part of the spectrum; QR and Rayleigh-Ritz follow, until residuals certify
the eigenvectors. Small blocks (dimensions x vectors) are all the driver sees; their size does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.session import stored

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)  # entries beyond +-2^40 after scaling count as these, so that sums stay exact
DEGREE, MOST_DEGREE = 10, 40
LANCZOS_STEPS = 8
CERTIFIED = 1e-13  # residual against the largest eigenvalue
EXACT = 1 << 62

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Fit:
    """Of one vector length: rows n of the fit list, sums S, eigenvalues and eigenvectors (columns), trace, identity error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None


def integers(vector: Column) -> Column:
    """floor(64 * entry) + 1000000 of every entry, as long."""
    def whole(c: Column) -> Column:
        scaled = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double") * SCALE))
        return F.floor(scaled).cast("long") + SHIFT

    return F.transform(vector, whole)


def usable(vector: Column) -> Column:
    """Neither NULL nor with NULL, NaN or infinite entries."""
    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf")))

    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def _rows(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly; Python integers where 64 bits do not hold them."""
    if max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums))) * 2 < EXACT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _rows(batch, d)
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([str(v) for v in [n, *total]])], ["dim", "total"])

    parts = fit.mapInArrow(partial, "dim int, total string")
    found = {r.dim: int(r.total) for r in parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    return found.get(-1, 0), [found.get(k, 0) for k in range(d)]


def _product(fit: DataFrame, n: int, sums: list[int]) -> Product:
    """Q -> V Q, one pass over the fit list: V is the covariance, rows are centred before they are multiplied."""
    d = len(sums)

    def times(block: np.ndarray) -> np.ndarray:
        k = block.shape[1]

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, k))
            for batch in batches:
                centred = _offsets(_rows(batch, d), n, sums).astype(np.float64) / n
                total += centred.T @ (centred @ block)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), *map(pa.array, total.T)], ["dim", *[f"y{j}" for j in range(k)]])

        parts = fit.mapInArrow(partial, ", ".join(["dim int", *[f"y{j} double" for j in range(k)]]))
        rows = parts.groupBy("dim").agg(*[F.sum(f"y{j}").alias(f"y{j}") for j in range(k)]).collect()
        out = np.zeros((d, k))
        for row in rows:
            out[row[0]] = row[1:]
        return out / n

    return times


def _lanczos_floor(times: Product, d: int, rng: np.random.Generator) -> float:
    """A value near the smallest eigenvalue: the lowest Ritz value of a few Lanczos steps, less its residual, not below 0."""
    q, before, beta, alphas, betas = rng.standard_normal(d), np.zeros(d), 0.0, [], []
    basis: list[np.ndarray] = []
    q /= np.linalg.norm(q)
    for _ in range(min(LANCZOS_STEPS, d)):
        w = times(q[:, None])[:, 0] - beta * before
        alphas.append(float(q @ w))
        w -= alphas[-1] * q
        basis.append(q)
        for b in basis:
            w -= (b @ w) * b
        beta = float(np.linalg.norm(w))
        betas.append(beta)
        if beta <= 1e-12 * max(map(abs, alphas)):
            break
        before, q = q, w / beta
    m = len(alphas)
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[: m - 1], 1) + np.diag(betas[: m - 1], -1))
    return max(0.0, float(values[0] - betas[m - 1] * abs(vectors[-1, 0])))


def leading(times: Product, d: int, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their eigenvectors (columns) of the symmetric d x d operator ``times``.

    The block has 3k vectors (d at most). The filter's interval goes from near the smallest eigenvalue to the block's smallest
    Ritz value, and all wanted ones lie above it. If a round does not certify the vectors the degree rises, then the block grows; a
    block of d vectors makes Rayleigh-Ritz exact, so the iteration ends on any spectrum.
    """
    k, rng = min(k, d), np.random.default_rng(seed)
    size, degree = min(d, 3 * k), DEGREE
    low = _lanczos_floor(times, d, rng) if size < d else 0.0
    block = np.linalg.qr(rng.standard_normal((d, size)))[0]
    last = np.inf
    while True:
        image = times(block)
        small = block.T @ image
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        block, image = block @ rotation, image @ rotation
        residual = float(np.linalg.norm(image[:, :k] - block[:, :k] * values[:k], axis=0).max(initial=0.0))
        scale = max(float(values[0]), 0.0)
        if residual <= CERTIFIED * scale or size == d or scale == 0.0:
            return values[:k], block[:, :k]
        if residual <= 100 * CERTIFIED * scale and residual > last / 2:  # rounding is reached
            return values[:k], block[:, :k]
        if residual > last / 10:
            if degree < MOST_DEGREE:
                degree = min(2 * degree, MOST_DEGREE)
            else:
                size = min(d, size + max(k, size // 2))
        last = residual
        centre, half = (values[-1] + low) / 2, max((values[-1] - low) / 2, 1e-3 * scale)
        # Scaled recurrence: the largest Ritz value keeps its size, the interval is damped.
        sigma = first = half / max(values[0] - centre, half)
        before, now = block, (image - centre * block) * (sigma / half)
        for _ in range(degree - 1):
            rising = 1 / (2 / first - sigma)
            before, now = now, 2 * (rising / half) * (times(now) - centre * now) - sigma * rising * before
            sigma = rising
        if size > now.shape[1]:
            now = np.hstack([now, rng.standard_normal((d, size - now.shape[1]))])
        block = np.linalg.qr(now / np.maximum(np.linalg.norm(now, axis=0), 1e-300))[0]


def _trace(fit: DataFrame, n: int, sums: list[int]) -> float:
    d = len(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            total += float(((_offsets(_rows(batch, d), n, sums).astype(np.float64) / n) ** 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["total"])

    return float(fit.mapInArrow(partial, "total double").agg(F.sum("total")).first()[0] or 0.0) / n


def fit_whitening(fit: DataFrame, d: int, k: int = 16) -> Fit:
    """``fit``: one column ``x``, arrays of ``d`` longs, each distinct vector once, stored. At least one row."""
    n, sums = _sums(fit, d)
    times = _product(fit, n, sums)
    values, vectors = leading(times, d, k)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = _trace(fit, n, sums)
    spread = values > 64 * d * np.finfo(float).eps * max(float(values.max(initial=0.0)), 0.0)
    error = None
    if spread.any():
        weights = vectors[:, spread] / np.sqrt(values[spread])
        error = float(np.abs(weights.T @ times(weights) - np.eye(weights.shape[1])).max())
    return Fit(n, sums, np.where(spread, values, 0.0), vectors, trace, error)


def _whitened(rows: DataFrame, fit: Fit, kind: str, id_col: str) -> DataFrame:
    n, sums, d, k = fit.n, fit.sums, len(fit.sums), len(fit.values)
    spread = fit.values > 0
    weights = fit.vectors / np.sqrt(np.where(spread, fit.values, 1.0))
    explained = [float(v) / fit.trace if fit.trace > 0 else None for v in fit.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = _offsets(_rows(batch, d), n, sums)
            big = int(np.abs(offsets).max()) ** 2 * d >= EXACT
            exact = offsets.astype(object) if big else offsets
            deviation = (exact * exact).sum(axis=1)
            out = (offsets.astype(np.float64) / n) @ weights
            m = batch.num_rows
            mask = np.tile(~spread, m)
            yield pa.RecordBatch.from_arrays([
                batch.column(id_col).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array([str(v) for v in deviation.tolist() for _ in range(k)]), pa.array(out.reshape(-1), mask=mask), pa.array(explained * m, pa.float64()),
                pa.array([fit.identity_error] * (m * k), pa.float64()),
            ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = rows.mapInArrow(project, f"id {kind}, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(embeddings: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are NULL or hold NULL or non-finite entries are left out. Entries become integers (see ``integers``), and every
    distinct integer vector is once in the fit list, however many rows repeat it. n and sums are exact, and so is n * x - S, from which
    deviation (sum of its squares, decimal) and the projections start. Components are numbered by falling eigenvalue, as
    many as dimensions if those are fewer; one without variance (all vectors alike, fewer vectors than dimensions) has
    NULL as ``whitened`` and explains 0, or NULL if nothing varies at all. Vectors of different lengths are different tables, each
    whitened by itself; empty vectors have no components. Repeated rows and NULL ids keep their rows, other columns are ignored,
    an empty table gives an empty one.
    """
    kind = dict(embeddings.dtypes)[id_col]
    rows = embeddings.where(usable(F.col(vector_col)) & (F.size(vector_col) > 0)).select(F.col(id_col), integers(F.col(vector_col)).alias("x"))
    rows = stored(rows.withColumn("length", F.size("x")), "integers")
    distinct = stored(rows.select("x", "length").distinct(), "distinct")
    out = None
    for length in sorted(r.length for r in distinct.select("length").distinct().collect()):
        fit = fit_whitening(distinct.where(F.col("length") == length).select("x"), length, components)
        part = _whitened(rows.where(F.col("length") == length).select(id_col, "x"), fit, kind, id_col)
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = f"{id_col} {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return embeddings.sparkSession.createDataFrame([], schema)
    return out
