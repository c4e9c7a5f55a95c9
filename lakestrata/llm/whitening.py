"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers ``floor(256 * c)``; the fit list has each distinct
vector once, stored in blocks of rows. ``X`` stands for its rows less their mean.
From a first direction v the bidiagonalisation alternates u = Xv and w = X'u; both
products of a step are taken in one distributed pass over the blocks, which returns a few
sums of the width of a vector. Left vectors have a number a row and stay where the rows are: each is
X times a short vector, from which a task computes its part anew. Every new
vector is orthogonalised against all before it, on both sides and twice. Where the
recurrence breaks down, a new direction orthogonal to all others goes on.

The singular values of the small bidiagonal matrix B are the deviations (times the root of n),
its right singular vectors the components. The steps end when the residuals of the
wanted components are at rounding level and the variance outside of the directions so far, known
from the total, is less than the least wanted one: then no direction that
was never met can belong to the first. At the latest they end with the width of the vectors.

Defined results: a vector that is null or has a null or non-finite component takes
no part; a shorter vector counts as padded with zeros; repeated rows are one vector of
the fit list and rows of their own in the result; a null id stays null; there are no more
components than the vectors have variance in (none for a single distinct vector), so rows of
such components are absent; a deviation beyond 64 bits is null; an empty table gives an
empty result. Only the id and the vector are read, so other columns cannot clash; very wide
vectors make wider sums, and blocks of fewer rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import discard, stored

#: Numbers of a block of rows, at most; rows of a batch whose results are made at once.
BLOCK, BATCH = 262_144, 2048
_EPS = np.finfo(float).eps


def scaled(vector: Column) -> Column:
    """``floor(256 * c)`` of each component; null where one is null or not finite."""
    c = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(c, lambda v: F.floor(256 * v)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def fit_blocks(vectors: DataFrame, width: int) -> DataFrame:
    """(rows): blocks of the distinct vectors, as 64-bit numbers row by row."""
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    most = max(1, BLOCK // max(width, 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                held.append(_matrix(batch.column(0).slice(at, most), width))
                n += len(held[-1])
                if n >= most:
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["rows"])
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["rows"])

    return vectors.select(padded.alias("x")).distinct().mapInArrow(run, "rows binary")


def summed(blocks: DataFrame, work: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of ``work`` (an array of one length) over all blocks: one row a task, added by Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows in batch.column(0):
                got = work(np.frombuffer(rows.as_buffer(), np.int64).reshape(-1, width))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["at", "part"])

    parts = blocks.mapInArrow(run, "at int, part double")
    rows = parts.groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(len(rows))
    for r in rows:
        out[r["at"]] = r["total"]
    return out


def exact_sums(blocks: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """(number of rows, sums of each component), exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                x = np.frombuffer(rows.as_buffer(), np.int64).reshape(-1, width)
                # halves of 32 bits add up without overflow
                sums = [int(a) * 2**32 + int(b) for a, b in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([str(v) for v in (len(x), *sums)])], ["at", "part"])

    rows = blocks.mapInArrow(run, "at int, part string").groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    total = {r["at"]: int(r["total"]) for r in rows}
    return total.get(-1, 0), np.array([total.get(i, 0) for i in range(width)], object)


class Components:
    """Of the fit list: rows n, sums S, and the first components with their variances."""

    def __init__(self, n: int, sums: np.ndarray, vectors: np.ndarray, variances: np.ndarray, trace: float):
        self.n, self.sums, self.vectors, self.variances, self.trace = n, sums, vectors, variances, trace


def _free(directions: np.ndarray, seed: int) -> np.ndarray:
    """A unit vector orthogonal to the rows of ``directions``."""
    v = np.random.default_rng(seed).normal(size=directions.shape[1])
    for _ in range(3):
        v -= directions.T @ (directions @ v)
        v /= np.linalg.norm(v)
    return v


def step_products(y: np.ndarray, left: np.ndarray, mean: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """X'p, U'p and p'p for p = Xy, of a block's rows."""

    def products(x: np.ndarray) -> np.ndarray:
        x = x - mean
        p = x @ y
        return np.concatenate((x.T @ p, (x @ left.T).T @ p, [p @ p]))

    return products


def bidiagonalised(blocks: DataFrame, n: int, mean: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(right vectors as rows, B, total variance times n) of the centred fit list."""
    width = len(mean)

    def total_of(x: np.ndarray) -> np.ndarray:
        return ((x - mean) ** 2).sum(0)

    total = float(summed(blocks, total_of, width).sum())
    right = np.zeros((0, width))
    left = np.zeros((0, width))  # row j: the y of u_j = X y
    image = np.zeros((0, width))  # row j: X'u_j
    alphas, betas = [], []
    v = _free(right, 0)
    while total > 0:
        before = betas[-1] if betas else 0.0
        y = v - before * left[-1] if len(left) else v.copy()

        alpha, w = 0.0, np.zeros(width)
        for _ in range(3):
            got = summed(blocks, step_products(y, left, mean), width)
            w, across, square = got[:width], got[width:-1], max(got[-1], 0.0)
            # less the parts along earlier left vectors, from a fresh pass where those were large
            y, w = y - left.T @ across, w - image.T @ across
            alpha = np.sqrt(max(square - across @ across, 0.0))
            if np.linalg.norm(across) <= 1e-8 * np.sqrt(square):
                break
        if alpha <= 8 * _EPS * np.sqrt(total) * width:  # X v lies in what the left vectors span
            alpha, y, w = 0.0, np.zeros(width), np.zeros(width)
        else:
            y, w = y / alpha, w / alpha
        right, left, image = np.vstack((right, v)), np.vstack((left, y)), np.vstack((image, w))
        alphas.append(alpha)
        following = w - alpha * v
        for _ in range(2):
            following -= right.T @ (right @ following)
        beta = float(np.linalg.norm(following))
        b = np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas)
        small, values, _ = np.linalg.svd(b)
        kept = min(wanted, len(values))
        residual = beta * np.abs(small[-1, :kept]).max()
        outside = total - float((values**2).sum())
        if len(right) == width or (len(values) >= wanted and residual <= 4 * _EPS * values[0] and outside < values[wanted - 1] ** 2):
            break
        if beta <= 8 * _EPS * np.sqrt(total) * width:
            beta, following = 0.0, _free(right, len(right))
        else:
            following = following / beta
        betas.append(beta)
        v = following
    b = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1) if len(alphas) > 1 else np.diag(alphas)
    return right, b.reshape(len(alphas), len(alphas)), total


def fit(blocks: DataFrame, width: int, components: int = 4) -> Components:
    n, sums = exact_sums(blocks, width) if width else (0, np.zeros(0, object))
    if not n:
        return Components(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)
    mean = np.array([float(s) / n for s in sums])
    right, b, total = bidiagonalised(blocks, n, mean, min(components, width))
    if not total:
        return Components(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)
    _, values, turn = np.linalg.svd(b)
    kept = int((values[:components] ** 2 > total * width * 16 * _EPS).sum())
    vectors = turn[:kept] @ right
    return Components(n, sums, vectors / np.linalg.norm(vectors, axis=1)[:, None], values[:kept] ** 2 / n, total / n)


def identity_error(blocks: DataFrame, found: Components) -> float:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    k, width = found.vectors.shape
    mean = np.array([float(s) / found.n for s in found.sums])
    turn = (found.vectors / np.sqrt(found.variances)[:, None]).T

    def products(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ turn
        return (w.T @ w).ravel()

    return float(np.abs(summed(blocks, products, width).reshape(k, k) / found.n - np.eye(k)).max()) if k else 0.0


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the components of (n x - S)^2 of each row, exactly; null beyond 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if most < 2**62 and most * most * max(x.shape[1], 1) < 2**63:
        d = n * x - sums.astype(np.int64)
        return (d * d).sum(1).tolist()
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def whitened(vectors: DataFrame, width: int, found: Components, error: float, id_col: str) -> DataFrame:
    """A row for each row of ``vectors`` (id, x) and component."""
    k = len(found.vectors)
    mean = np.array([float(s) / max(found.n, 1) for s in found.sums])
    turn = (found.vectors / np.sqrt(found.variances)[:, None]).T
    explained = found.variances / found.trace if k else np.zeros(0)
    schema = f"{id_col} long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, BATCH):
                part = batch.slice(at, BATCH)
                x = _matrix(part.column(1), width)
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, found.n, np.int64)), pa.array(deviations(x, found.n, found.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(((x - mean) @ turn).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)


def whiten(data: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every vector and component."""
    raw = data.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col)).alias("x"))
    vectors = stored(raw.filter(F.col("x").isNotNull()), "whitening-vectors")
    width = vectors.select(F.max(F.size("x"))).first()[0] or 0
    blocks = stored(fit_blocks(vectors, width), "whitening-blocks")
    found = fit(blocks, width, components)
    error = identity_error(blocks, found) if len(found.vectors) else 0.0
    discard(blocks)
    return whitened(vectors, width, found, error, id_col)
