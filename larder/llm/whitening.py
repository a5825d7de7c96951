"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

``A`` holds the distinct integer vectors, centred, one row each; it is never multiplied with
itself.  Each step is one Spark job over the rows: ``w = A v - b u`` and the sums ``U'w``, ``w'w``
and ``A'w``.  A left vector is ``A`` times a short vector of coefficients, so tasks build all
earlier ones anew from rows and coefficients and nothing as long as the table is kept.  Both
sides are orthogonalised against all their predecessors.  The singular values and vectors of the
small upper bidiagonal matrix give deviations and components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import reachable, stored

#: Entries of this size or more have no exact integer form here; their rows take no part.
LARGEST = 2.0 ** 40
_OUT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double")


@dataclass(frozen=True)
class Model:
    """What vectors of one length are whitened by: a few numbers for each dimension."""

    dims: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray   # dims x k, unit columns
    values: np.ndarray       # k falling eigenvalues of the covariance
    trace: float
    identity_error: float


def _of_length(column: pa.Array):
    """For each length of the usable vectors of a list column: rows and their entries."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dims)
        block = flat[starts[rows][:, None] + np.arange(dims)]
        good = (np.abs(block) < LARGEST).all(1)  # false for NaN and infinity
        yield int(dims), rows[good], block[good]


def _integers(block: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.floor(block * scale).astype(np.int64) + shift


def _offsets(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - S`` exactly: in 64 bits where they are enough, else in Python's integers."""
    if len(x) and int(np.abs(x).max()) * n + max(abs(int(s)) for s in sums) >= 1 << 62:
        return x.astype(object) * n - sums
    return x * n - sums.astype(np.int64)


def _squares(offsets: np.ndarray) -> list[int]:
    if offsets.dtype != object:
        most = int(np.abs(offsets).max(initial=0))
        if most * most * offsets.shape[1] < 1 << 63:
            return (offsets * offsets).sum(1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in offsets]


def distinct_vectors(vectors: DataFrame, embedding: str, scale: int, shift: int) -> DataFrame:
    """``dims, x``: each distinct integer vector once, as packed 64-bit integers."""
    def each(batches):
        for batch in batches:
            for dims, _, block in _of_length(batch.column(0)):
                x = _integers(block, scale, shift)
                yield pa.record_batch({"dims": pa.array(np.full(len(x), dims, np.int32)),
                                       "x": pa.array([r.tobytes() for r in x], pa.binary())})

    return vectors.select(embedding).mapInArrow(each, "dims int, x binary").distinct()


class _Rows:
    """The centred rows of one length and sums over them, one Spark job each."""

    def __init__(self, fit: DataFrame, dims: int):
        self.rows, self.dims = fit.filter(F.col("dims") == dims).select("x"), dims
        self.n = self.rows.count()

        def totals(batches):
            for batch in batches:
                sums = _unpacked(batch, dims).sum(0)  # a batch of 2^46 at most each
                yield pa.record_batch({"i": pa.array(np.arange(dims, dtype=np.int32)),
                                       "s": pa.array(sums)})

        got = self.rows.mapInArrow(totals, "i int, s long").groupBy("i").agg(
            F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        self.sums = np.array([0] * dims, object)
        for r in got:  # one row a dimension
            self.sums[r["i"]] = int(r["s"])

    def total(self, size: int, each) -> np.ndarray:
        """The sum over all blocks of centred rows of ``each(block)``, ``size`` numbers."""
        dims, n, sums = self.dims, self.n, self.sums

        def task(batches):
            out = np.zeros(size)
            for batch in batches:
                out += each(_offsets(_unpacked(batch, dims), n, sums).astype(float) / n)
            yield pa.record_batch({"i": pa.array(np.arange(size, dtype=np.int32)), "s": pa.array(out)})

        got = self.rows.mapInArrow(task, "i int, s double").groupBy("i").agg(F.sum("s")).toArrow()
        out = np.zeros(size)
        out[got.column(0).to_numpy()] = got.column(1).to_numpy()
        return out


def _unpacked(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    data = b"".join(v.as_py() for v in batch.column(0))
    return np.frombuffer(data, np.int64).reshape(-1, dims)


def bidiagonalise(rows: _Rows, k: int, seed: int = 5, accuracy: float = 1e-14):
    """``values, components, total``: the ``k`` largest singular values of the centred rows, those
    of rounding's size left out, their right vectors, and the sum of all squares.

    Steps end when the residuals of the first ``k`` are within ``accuracy`` of the largest value,
    or after ``dims`` steps, when the bidiagonal form is complete.
    """
    d, random = rows.dims, np.random.default_rng(seed)
    total = float(rows.total(1, lambda a: np.array([(a * a).sum()]))[0])
    scale = np.sqrt(total)
    V, P, T = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas, betas = [], []
    v, beta = _unit(random, V), 0.0
    while scale > 0 and v is not None:
        p = v - beta * P[:, -1] if beta else v.copy()
        V, kept = np.column_stack([V, v]), P

        def sums(a, p=None):  # U'w, w'w, A'w of a block, U and w from their coefficients
            both = a @ np.column_stack([kept, p])
            w = both[:, -1]
            return np.concatenate([both.T @ w, a.T @ w])

        for _ in range(3):  # again while most of w was taken away, as rounding stays behind
            got = rows.total(kept.shape[1] + 1 + d, lambda a, p=p: sums(a, p))
            h, ww, t = got[:kept.shape[1]], got[kept.shape[1]], got[kept.shape[1] + 1:]
            p, t, left = p - kept @ h, t - T @ h, ww - h @ h
            if left > 0.5 * ww or ww <= (1e-15 * scale) ** 2:
                break
        alpha = float(np.sqrt(max(left, 0.0)))
        if alpha <= 1e-14 * scale:  # A v lies in what is known: no new left vector
            alpha, p, t = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, t = p / alpha, t / alpha
        P, T = np.column_stack([P, p]), np.column_stack([T, t])
        alphas.append(alpha)
        rest = t - alpha * v
        for _ in range(2):
            rest -= V @ (V.T @ rest)
        beta = float(np.linalg.norm(rest))
        left_vectors, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        if len(alphas) == d:
            break
        if beta <= 1e-14 * scale:  # an invariant space: go on from a new direction
            v, beta = _unit(random, V), 0.0
        else:
            v = rest / beta
            if len(alphas) >= k and (beta * np.abs(left_vectors[-1, :k]) <= accuracy * values[0]).all():
                break
        betas.append(beta)
    if not alphas:
        return np.zeros(0), np.zeros((d, 0)), total
    size = len(alphas)
    kept = [i for i in range(min(k, size)) if values[i] > 1e-13 * d * values[0]]
    return values[kept], V[:, :size] @ right.T[:, kept], total


def _unit(random, known: np.ndarray) -> np.ndarray | None:
    """A random unit vector at right angles to ``known``; none if that spans everything."""
    if known.shape[1] >= known.shape[0]:
        return None
    v = random.standard_normal(known.shape[0])
    for _ in range(3):
        v -= known @ (known.T @ v)
        v /= np.linalg.norm(v)
    return v


def fitted(rows: _Rows, k: int) -> Model:
    """Components and deviations of the rows, and how far their whitened covariance is from one."""
    values, components, total = bidiagonalise(rows, k)
    n, k = rows.n, len(values)
    weights = components / np.where(values > 0, values, 1) * np.sqrt(n)

    def moments(a):
        z = a @ weights
        return np.concatenate([z.sum(0), (z.T @ z).ravel()])

    error = 0.0
    if k:
        got = rows.total(k + k * k, moments) / n
        cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        error = float(np.abs(cov - np.eye(k)).max())
    return Model(rows.dims, n, tuple(rows.sums), components, values ** 2 / n, total / n, error)


def whitened(vectors: DataFrame, k: int = 16, *, vec_id: str = "vec_id",
             embedding: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each
    usable vector and each of its ``k`` first components, numbered from 1 by falling variance.

    Entries become integers ``floor(scale * c) + shift``; components are fitted on each distinct
    integer vector once (``n`` of them), ``deviation`` is the exact sum of ``(n x - S)^2``.
    Rows whose vector is null or empty, or holds a null, a non-finite number or one of
    ``LARGEST`` or more, give no rows.  Repeated rows and null ids give their own rows.  Vectors
    of each length are fitted by themselves.  Components without variance are not returned, so
    equal vectors alone, and an empty table, give no rows.  The driver and each task hold
    dimensions x steps numbers.
    """
    spark = vectors.sparkSession
    reachable(spark)
    own = vectors.select(F.col(embedding).alias("v"), F.col(vec_id).cast("long").alias("id"))
    fit = stored(distinct_vectors(own, "v", scale, shift), "whitening-fit")
    lengths = sorted(r[0] for r in fit.select("dims").distinct().collect())
    models = {d: fitted(_Rows(fit, d), k) for d in lengths}

    def apply(batches):
        for batch in batches:
            for dims, at, block in _of_length(batch.column(0)):
                model = models[dims]
                if not len(at) or not len(model.values):
                    continue
                sums = np.array(model.sums, object)
                off = _offsets(_integers(block, scale, shift), model.n, sums)
                z = off.astype(float) / model.n @ (model.components / np.sqrt(model.values))
                k = z.shape[1]
                each = np.repeat(np.arange(len(at)), k)
                deviation = pa.array(_squares(off), pa.decimal128(38, 0)).take(pa.array(each))
                yield pa.record_batch({
                    "vec_id": batch.column(1).take(pa.array(at[each])),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(len(each), model.n)), "deviation": deviation,
                    "whitened": pa.array(z.ravel()),
                    "explained": pa.array(np.tile(model.values / model.trace, len(at))),
                    "identity_error": pa.array(np.full(len(each), model.identity_error))})

    return own.mapInArrow(apply, _OUT)
