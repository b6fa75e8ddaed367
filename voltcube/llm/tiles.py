"""Blocks of vectors and the scoring of queries against them, shared by the two vector searches.

Vectors travel as binary columns of doubles. A search deals vectors and queries to
cells; a cell with many of either is cut into tiles of bounded size (each part of the
vectors meets each part of the queries in one tile), so no group grows with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Vectors and queries in one tile, about.
TILE_VECTORS, TILE_QUERIES = 8192, 2048
FOUND = "query_id long, vec_id long, score double"


def encode(df: DataFrame, vec_id: str, vector: str, *, zero_ok: bool, scale: float | None = None) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their dimension (that of most rows).

    Null ids, null vectors, other dimensions, and null or non-finite components take no
    part; nor do zero vectors unless ``zero_ok``. With ``scale`` components become
    floor(scale * x)."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).filter("vec_id is not null and x is not null")
    dims = rows.groupBy(F.size("x").alias("d")).count().filter("d > 0").orderBy(F.desc("count"), "d").head()
    if dims is None:
        return rows.select("vec_id", F.lit(b"").alias("v")).limit(0), 0
    dim = dims.d

    def run(batches):
        for b in batches:
            x = b.column("x").values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            if scale:
                x = np.floor(scale * x)
            ok = np.isfinite(x).all(1)
            if not zero_ok:
                ok &= (x != 0).any(1)
            yield pa.record_batch({"vec_id": b.column("vec_id").filter(pa.array(ok)), "v": pa.array([r.tobytes() for r in x[ok]], pa.binary())})

    same = rows.filter(F.size("x") == dim)
    # Slices of an Arrow list column keep all its values, so the batch is rebuilt from whole rows only.
    return same.select("vec_id", "x").mapInArrow(run, "vec_id long, v binary"), dim


def matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), dim)


def best(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
    """The k best ids of each query in one tile that reach its floor: three arrays. Rows repeating an id count
    once, with their best score. Ties go to the smaller id."""
    out_q, out_v, out_s = [], [], []
    repeated = len(np.unique(ids)) < len(ids)
    if repeated:                                                  # of equal rows one; the rows of an id lie together
        once = np.array(list({(i, x.tobytes()): at for at, (i, x) in enumerate(zip(ids.tolist(), vectors, strict=True))}.values()))
        once = once[np.argsort(ids[once], kind="stable")]
        ids, vectors = ids[once], vectors[once]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    for at in range(0, len(query_ids), 256):
        rough = queries[at:at + 256] @ vectors.T
        for j, row in enumerate(rough):
            q = query_ids[at + j]
            row[ids == q] = -np.inf
            each = np.maximum.reduceat(row, first) if repeated else row
            low = np.partition(each, -k)[-k] if len(each) > k else -np.inf
            low = max(low, floor[at + j])
            low -= 1e-9 * (1 + abs(low)) if np.isfinite(low) else 0
            near = np.flatnonzero((row >= low) & (row > -np.inf))
            if not len(near):
                continue
            score = (vectors[near] * queries[at + j]).sum(1)      # the same sum for equal vectors, wherever they are
            top = np.lexsort((ids[near], -score))
            if repeated:
                top = top[np.sort(np.unique(ids[near][top], return_index=True)[1])]
            top = top[:k]
            out_q.append(np.full(len(top), q))
            out_v.append(ids[near][top])
            out_s.append(score[top])
    cat = lambda xs, t: np.concatenate([*xs, np.zeros(0, t)]).astype(t)
    return cat(out_q, np.int64), cat(out_v, np.int64), cat(out_s, np.float64)


def score(vectors: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): per tile the k best. ``vectors``: (cell, vec_id, v); ``queries``: (cell,
    query_id, v, floor). The number of cells is bounded by the caller; their sizes come to the driver."""
    spark = vectors.sparkSession
    nv = {r.cell: r["count"] for r in vectors.groupBy("cell").count().collect()}
    nq = {r.cell: r["count"] for r in queries.groupBy("cell").count().collect()}
    split = [(c, -(-nv[c] // TILE_VECTORS), -(-nq[c] // TILE_QUERIES)) for c in nv.keys() & nq.keys()]
    split = F.broadcast(spark.createDataFrame(split or [(-1, 1, 1)], "cell int, vs int, qs int"))
    left = (vectors.join(split, "cell").withColumn("vp", F.pmod(F.xxhash64("vec_id"), F.col("vs")).cast("int"))
                   .withColumn("qp", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
                   .select("cell", "vp", "qp", F.lit(False).alias("query"), F.col("vec_id").alias("id"), "v", F.lit(0.0).alias("floor")))
    right = (queries.join(split, "cell").withColumn("qp", F.pmod(F.xxhash64("query_id"), F.col("qs")).cast("int"))
                    .withColumn("vp", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)))
                    .select("cell", "vp", "qp", F.lit(True).alias("query"), F.col("query_id").alias("id"), "v", "floor"))

    def run(t: pa.Table) -> pa.Table:
        is_query = t.column("query").to_numpy()
        ids, floor, x = t.column("id").to_numpy(), t.column("floor").to_numpy(), matrix(t.column("v"), dim)
        got = best(ids[~is_query], x[~is_query], ids[is_query], x[is_query], floor[is_query], k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, got), strict=True)))

    return left.union(right).groupBy("cell", "vp", "qp").applyInArrow(run, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query; a vector found twice counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Centres and each row's nearest one."""
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        d = (centres ** 2).sum(1) - 2 * x @ centres.T
        near = d.argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return centres, ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
