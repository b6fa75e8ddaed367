"""Operator 8: exact top-k search by inner product over a pivot-distance index.

An extra component sqrt(M^2 - |x|^2) (M: the largest norm) gives all vectors one norm, so
the largest inner products are the smallest Euclidean distances. Each vector is keyed by
its nearest pivot and its distance to it; the distances of a pivot are cut into rings
(annuli). A query orders the annuli by the least distance that the triangle inequality
allows in them, |d(query, pivot) - d(x, pivot)|, scores the nearest ones, and goes on in
larger and larger batches. It stops at the annulus whose bound is behind its k-th result,
so nothing that could enter the result is left out.

Defined results: null ids, null vectors, null or non-finite components and vectors of
another dimension than most take no part (zero vectors do); rows repeating a vec_id count
as one candidate with its best score; fewer candidates than k are all returned; an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltcube.llm import tiles
from voltcube.llm.common import cut, drop_path

#: Vectors that pivots are chosen from (about), vectors of an annulus, and annuli at most (they may get larger).
SAMPLE, ANNULUS, CELLS = 8192, 2048, 4096
#: Annuli of a query's batches; the last batch is all the rest.
BATCHES = (2, 8, None)


@dataclass
class Rings:
    """The annuli: their pivot, smallest and largest distance; ``norm2``: M^2."""

    pivots: np.ndarray
    norm2: float
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def distances(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Distance of each (extended) row to each pivot."""
        y = np.hstack([x, extra[:, None]])
        d = (y ** 2).sum(1)[:, None] + (self.pivots ** 2).sum(1) - 2 * y @ self.pivots.T
        return np.sqrt(np.maximum(d, 0))

    def extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norm2 - (x ** 2).sum(1), 0))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and annulus: the least distance, and the largest inner product it leaves possible."""
        d = self.distances(queries, np.zeros(len(queries)))[:, self.pivot]
        least = np.maximum(0, np.maximum(d - self.high, self.low - d))
        slack = 1e-6 * (1 + self.norm2 + (queries ** 2).sum(1)[:, None])
        return least, (self.norm2 + (queries ** 2).sum(1)[:, None] - least ** 2) / 2 + slack


def build(vectors: DataFrame, dim: int, n: int) -> tuple[DataFrame, Rings, str]:
    """(cell, vec_id, v) written, and the annuli (at most CELLS)."""
    spark = vectors.sparkSession
    once = vectors.groupBy("vec_id").agg(F.min("v").alias("v"))          # a hot id is one vector of the sample
    sample = tiles.matrix(once.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("v"), dim)

    def norms(batches):
        for b in batches:
            x = tiles.matrix(b.column("v"), dim)
            yield pa.record_batch({"n2": pa.array([float((x ** 2).sum(1).max(initial=0))])})

    norm2 = vectors.select("v").mapInArrow(norms, "n2 double").agg(F.max("n2")).head()[0] or 0.0
    rings = Rings(np.zeros((1, dim + 1)), norm2, *[np.zeros(0)] * 3)
    pivots = int(np.clip(n // (4 * ANNULUS), 1, 64))
    if len(sample):
        y = np.hstack([sample, rings.extra(sample)[:, None]])
        rings.pivots = tiles.kmeans(y, min(pivots, len(y)), np.random.default_rng(1))[0]
    per = int(np.clip(-(-n // (ANNULUS * len(rings.pivots))), 1, CELLS // len(rings.pivots)))

    def key(batches):
        for b in batches:
            x = tiles.matrix(b.column("v"), dim)
            d = rings.distances(x, rings.extra(x))
            near = d.argmin(1)
            yield pa.record_batch({"pivot": pa.array(near, pa.int32()), "dist": pa.array(d[np.arange(len(d)), near]), "vec_id": b.column("vec_id"), "v": b.column("v")})

    keyed, keyed_path = cut(spark, vectors.mapInArrow(key, "pivot int, dist double, vec_id long, v binary"), "topk-keys")
    # Where the rings are cut only decides the work, not the result.
    edges = {}
    if per > 1:
        share = F.array(*[F.lit(i / per) for i in range(1, per)])
        edges = {r.pivot: r.e for r in keyed.groupBy("pivot").agg(F.percentile_approx("dist", share, 2000).alias("e")).collect()}
    ring = F.lit(0)
    if edges:
        cuts = F.broadcast(spark.createDataFrame([(p, list(e)) for p, e in edges.items()], "pivot int, e array<double>"))
        keyed = keyed.join(cuts, "pivot")
        ring = F.size(F.filter("e", lambda x: x < F.col("dist")))
    cells = keyed.withColumn("cell", (F.col("pivot") * per + ring).cast("int"))
    meta = cells.groupBy("cell").agg(F.min("dist").alias("low"), F.max("dist").alias("high")).orderBy("cell").collect()
    ids = np.array([m.cell for m in meta], np.int64)
    rings.pivot, rings.low, rings.high = ids // per, np.array([m.low for m in meta]), np.array([m.high for m in meta])
    names = {int(c): i for i, c in enumerate(ids)}
    renamed = F.broadcast(spark.createDataFrame(list(names.items()) or [(-1, -1)], "cell int, nr int"))
    return cells.join(renamed, "cell").select(F.col("nr").alias("cell"), "vec_id", "v"), rings, keyed_path


def search(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, scale: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the k others of
    largest inner product (components taken as floor(scale * x) if a scale is given)."""
    spark = df.sparkSession
    vectors, dim = tiles.encode(df, vec_id, vector, zero_ok=True, scale=scale)
    vectors, path = cut(spark, vectors, "topk-vectors")
    cells, rings, keyed_path = build(vectors, dim, vectors.count())
    shared = spark.sparkContext.broadcast(rings)
    todo = vectors.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", F.lit(float("-inf")).alias("floor"))
    queries, found, done, paths = todo, None, 0, [path, keyed_path]
    for batch in BATCHES:
        upto = len(rings.pivot) if batch is None else done + batch

        def expand(batches, start=done, stop=upto):
            r = shared.value
            for b in batches:
                x, floor = tiles.matrix(b.column("v"), dim), b.column("floor").to_numpy()
                for at in range(0, len(x), 512):
                    least, most = r.bounds(x[at:at + 512])
                    order = least.argsort(1, kind="stable")[:, start:stop]
                    keep = np.take_along_axis(most, order, 1) >= floor[at:at + 512, None]
                    q = np.repeat(np.arange(at, at + len(keep)), keep.sum(1))
                    yield pa.record_batch({"cell": pa.array(order[keep], pa.int32()), "query_id": b.column("query_id").take(pa.array(q)),
                                           "v": b.column("v").take(pa.array(q)), "floor": pa.array(floor[q])})

        asked = queries.mapInArrow(expand, "cell int, query_id long, v binary, floor double")
        new = tiles.score(cells, asked, dim, k)
        found, p = cut(spark, new if found is None else found.unionByName(new), "topk-found")
        paths.append(p)
        done = upto
        if done >= len(rings.pivot):
            break
        kth = (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                    .withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") == k)
                    .select("query_id", F.col("score").alias("low")))
        queries = todo.drop("floor").join(kth, "query_id", "left").select("query_id", "v", F.coalesce("low", F.lit(float("-inf"))).alias("floor"))
    for p in paths[:-1]:
        drop_path(spark, p)
    return tiles.top(found, k)
