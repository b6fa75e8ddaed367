"""Operator 11: whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

1. Components c become whole numbers x = floor(scale * c) + offset. One pass counts rows and sums
   each dimension, exactly.
2. Every task adds up the products of its rows' centred values. Rows are centred before
   multiplying, at the whole number below the mean, so all sums are whole numbers; what the
   mean has beyond it is taken off the total at the end. The scatter is therefore exact,
   whatever the order of tasks or the distance of the data from zero.
3. On the driver, whose work depends on the dimension only (``MOST_DIMS``): Cholesky of the
   scatter with diagonal pivots, stopped at its numerical rank, then one-sided Jacobi: plane
   rotations between columns of the triangular factor until all are orthogonal. Squared column
   norms over n are the eigenvalues of the covariance, normalised columns its eigenvectors.
4. Rows are projected on the leading components and divided by the root of the eigenvalue.
   The covariance of what was written is computed by Spark and compared with the identity.

Defined results: null vectors, vectors with null or non-finite entries, entries whose x is no 64-bit
number, and vectors of another length than most (ties: the shorter) take no part; rows without an
id take part and keep a null id; rows repeating an id or a vector count each; equal eigenvalues
have components in any order that spans the same space; directions without variance cannot be
whitened and are left out, so a table of equal rows, one row or none gives an empty result.
``deviation`` is decimal(38, 0), exact as far as that reaches (null beyond). Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.llm.common import cut

#: The scatter and its factor are held on the driver and the factor is broadcast, both of this size squared at most.
MOST_DIMS = 2048
SCALE, OFFSET = 1024.0, 100_000
#: Whole numbers up to this are exact in double precision; sums travel in two halves, split here.
EXACT, HALF = 1 << 53, 1 << 60
_SUMS = "i int, j int, hi decimal(38,0), lo decimal(38,0)"


class TooManyDimensions(ValueError):
    pass


def whole(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x of each row, and which rows take part."""
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.floor(SCALE * rows)
    ok = (np.abs(y) < 2.0 ** 62).all(1)              # false for NaN and infinities too
    return np.where(ok[:, None], y, 0).astype(np.int64) + OFFSET, ok


def read(b: pa.RecordBatch, dim: int, column: str) -> tuple[np.ndarray, np.ndarray]:
    """x of the batch's vectors, all of ``dim`` entries (nulls among them become NaN)."""
    flat = b.column(b.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return whole(flat.reshape(-1, dim))


def halves(i, j, values) -> pa.RecordBatch:
    """Rows (i, j, hi, lo) of whole numbers of any size."""
    t = pa.decimal128(38, 0)
    parts = [divmod(int(v), HALF) for v in values]
    return pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                            "hi": pa.array([h for h, _ in parts], t), "lo": pa.array([x for _, x in parts], t)})


def _total(sums: DataFrame) -> dict[tuple[int, int], int]:
    """{(i, j): sum}: as many rows as there are entries of a vector or of the scatter."""
    t = sums.groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).toArrow()
    return {(i, j): int(hi) * HALF + int(lo) for i, j, hi, lo in zip(*(t.column(c).to_pylist() for c in ("i", "j", "hi", "lo")), strict=True)}


def products(d: np.ndarray) -> np.ndarray:
    """d.T @ d exactly, as whole numbers: in double precision while all sums stay exact there."""
    most = int(np.abs(d).max(initial=0)) ** 2
    if most * max(1, len(d)) < EXACT:
        f = d.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if most < EXACT and len(d) > 1:
        mid = len(d) // 2
        return products(d[:mid]).astype(object) + products(d[mid:]).astype(object)
    wide = d.astype(object)
    return wide.T @ wide


def _column_sums(vectors: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows that take part, and the sum of x of each dimension."""

    def run(batches):
        n, sums = 0, np.zeros(dim, object)
        for b in batches:
            x, ok = read(b, dim, "x")
            n += int(ok.sum())
            sums += x[ok].sum(0, dtype=np.int64) if np.abs(x[ok]).max(initial=0) < 1 << 40 else x[ok].astype(object).sum(0)
        if n:
            yield halves([*range(dim), -1], [-1] * (dim + 1), [*sums, n])

    total = _total(vectors.mapInArrow(run, _SUMS))
    return total.get((-1, -1), 0), [total.get((i, -1), 0) for i in range(dim)]


def _scatter(vectors: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """Sum over all rows of (x - mean)(x - mean)^T, each entry rounded once."""
    at = np.array([s // n for s in sums], np.int64)
    shared = vectors.sparkSession.sparkContext.broadcast(at)
    upper = np.triu_indices(dim)

    def run(batches):
        total, any_row = np.zeros((dim, dim), object), False
        for b in batches:
            x, ok = read(b, dim, "x")
            if ok.any():
                total += products(x[ok] - shared.value)
                any_row = True
        if any_row:
            yield halves(upper[0], upper[1], total[upper])

    found = _total(vectors.mapInArrow(run, _SUMS))
    rest = [s - n * int(c) for s, c in zip(sums, at, strict=True)]       # n times what the mean has beyond the centre
    out = np.zeros((dim, dim))
    for (i, j), v in found.items():
        out[i, j] = out[j, i] = (n * v - rest[i] * rest[j]) / n          # whole numbers, divided once
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Factor L (rows in the order of ``a``) with L L^T = a: the largest remaining diagonal entry is the next
    pivot, until none stands out of the rounding of the largest."""
    a, d = a.copy(), len(a)
    diag = np.diag(a).copy()
    least = d * np.finfo(float).eps * max(diag.max(initial=0.0), 0.0)
    columns: list[np.ndarray] = []
    left = np.ones(d, bool)
    for _ in range(d):
        p = int(np.argmax(np.where(left, diag, -np.inf)))
        if diag[p] <= least:
            break
        col = a[:, p] - sum((c * c[p] for c in columns), np.zeros(d))
        col[~left] = 0.0
        col /= np.sqrt(diag[p])
        col[p] = np.sqrt(diag[p])
        left[p] = False
        columns.append(col)
        diag = diag - col * col
    return np.array(columns).T.reshape(d, len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared column norms, normalised columns) of the factor rotated until its columns are orthogonal, largest first.
    In a round of a sweep each column is rotated with one other; over the rounds every two meet."""
    g = factor.copy()
    r = g.shape[1]
    if r > 1:
        ring = np.arange(r + r % 2)
        for _ in range(sweeps):
            turned = False
            for _ in range(len(ring) - 1):
                p, q = ring[:len(ring) // 2], ring[::-1][:len(ring) // 2]
                real = (p < r) & (q < r)
                p, q = p[real], q[real]
                x, y = g[:, p], g[:, q]
                alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
                off = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
                if off.any():
                    turned = True
                    with np.errstate(divide="ignore", over="ignore"):
                        zeta = np.where(off, (beta - alpha) / np.where(off, 2 * gamma, 1), 0.0)
                        t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                    t = np.where(off, t, 0.0)
                    c = 1 / np.hypot(1.0, t)
                    g[:, p], g[:, q] = c * x - c * t * y, c * t * x + c * y
                ring = np.concatenate([ring[:1], np.roll(ring[1:], 1)])
            if not turned:
                break
    e = (g * g).sum(0)
    order = np.argsort(-e, kind="stable")
    return e[order], g[:, order] / np.sqrt(e[order])


@dataclass
class Whitening:
    """Fitted on all rows: ``centre + rest / n`` is the mean of x."""
    n: int
    centre: np.ndarray
    rest: list[int]
    eigenvalues: np.ndarray      # of the covariance, falling, all above rounding
    components: np.ndarray       # columns
    trace: float

    def project(self, x: np.ndarray, most: int) -> np.ndarray:
        y = (x - self.centre) - np.array([r / self.n for r in self.rest])
        k = min(most, len(self.eigenvalues))
        return y @ self.components[:, :k] / np.sqrt(self.eigenvalues[:k])

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2 of each row, exactly."""
        d, n = x - self.centre, self.n
        big, rest = int(np.abs(d).max(initial=0)), max(map(abs, self.rest), default=0)
        if max(big * big, big * rest) * max(1, d.shape[1]) < 1 << 62:
            squares, cross = (d * d).sum(1).tolist(), (d @ np.array(self.rest, np.int64)).tolist()
        else:
            wide = d.astype(object)
            squares, cross = (wide * wide).sum(1).tolist(), (wide @ np.array(self.rest, object)).tolist()
        const = sum(r * r for r in self.rest)
        return [n * n * s - 2 * n * c + const for s, c in zip(squares, cross, strict=True)]


def take_part(df: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, x array<double>) of vectors of the usual length, and that length."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).filter("x is not null and size(x) > 0")
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").head()
    if usual is None:
        return rows.limit(0), 0
    if usual.d > MOST_DIMS:
        raise TooManyDimensions(f"vectors of {usual.d} entries; at most {MOST_DIMS}")
    return rows.filter(F.size("x") == usual.d), usual.d


def fit(vectors: DataFrame, dim: int) -> Whitening | None:
    """None where no row takes part or none differs from the others."""
    n, sums = _column_sums(vectors, dim)
    if not n:
        return None
    scatter = _scatter(vectors, dim, n, sums)
    e, components = one_sided_jacobi(pivoted_cholesky(scatter))
    if not len(e):
        return None
    at = np.array([s // n for s in sums], np.int64)
    return Whitening(n, at, [s - n * int(c) for s, c in zip(sums, at, strict=True)], e / n, components, float(np.trace(scatter)) / n)


def whiten(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", most: int = 8) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error."""
    spark = df.sparkSession
    vectors, dim = take_part(df, vec_id, vector)
    model = fit(vectors, dim) if dim else None
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    k = min(most, len(model.eigenvalues))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            x, ok = read(b, dim, "x")
            w = shared.value.project(x[ok], most)
            dev = [v if v < 10 ** 38 else None for v in shared.value.deviation(x[ok])]
            yield pa.record_batch({"vec_id": b.column(0).filter(pa.array(ok)), "deviation": pa.array(dev, pa.decimal128(38, 0)),
                                   **{f"w{i}": pa.array(w[:, i]) for i in range(k)}})

    columns = [f"w{i}" for i in range(k)]
    rows, _ = cut(spark, vectors.mapInArrow(run, "vec_id long, deviation decimal(38,0), " + ", ".join(f"{c} double" for c in columns)), "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # covar_pop merges centred sums of the tasks; one row comes back.
    cov = rows.agg(*[F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs]).head()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    parts = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col(c).alias("whitened"), F.lit(float(model.eigenvalues[i] / model.trace)).alias("explained"))
                      for i, c in enumerate(columns)])
    return (rows.select("vec_id", "deviation", F.explode(parts).alias("p"))
                .select("vec_id", "p.component", F.lit(model.n).cast("long").alias("n"), "deviation", "p.whitened", "p.explained", F.lit(float(error)).alias("identity_error")))
