"""Operator 1: approximate nearest neighbours by inner product over balanced posting lists.

* Centroids come from a bounded sample (``SAMPLE``) by k-means that splits clusters until
  none is larger than a list should be, so the lists are balanced. Every vector is indexed.
* Boundary vectors are written to several lists: those of the nearest centroids within a
  distance ratio of the nearest one, at most ``REPLICAS``.
* Centroids (at most ``LISTS``) are searched by a graph in memory: each knows its nearest
  neighbours, and a beam walks it from a few entry points, many queries at a time.
* A query reads the lists whose centroid is within a distance ratio of the first one up to
  which the lists hold more than k vectors (its nearest one, unless that is a small list).
  The ratio is the one that finds ``RECALL`` of the neighbours of some sampled vectors within the
  sample; neighbours in the whole table are nearer, so it errs on the side of more lists. The
  beam is as wide as the lists that it opens: few where vectors are clustered, most of them
  where directions are random and no list rules out another.
  Queries still without k results go on through the lists in order of distance.

Inner products become distances by one more component, sqrt(M^2 - |x|^2), that gives all
vectors the largest norm. Scores are inner products of the original vectors in double
precision. Queries first score their nearest list; other lists return only what reaches
the k-th score found there.

Defined results: null ids, null or zero vectors, null or non-finite components and vectors
of another dimension than most take no part; rows repeating a vec_id count as one candidate
with its best score; fewer candidates than k are all returned; an empty table gives an
empty result. Extra columns are ignored.
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

#: Vectors the centroids are fitted on (at most), vectors of a list, and lists at most (they may get larger).
SAMPLE, LIST, LISTS = 32_768, 1024, 4096
#: Lists of a vector at most, and the distance ratio that chooses them.
REPLICAS, CLOSURE = 2, 1.01
#: Share of the sample's neighbours that the ratio of a table is to find, vectors it is measured on, and the least ratio.
RECALL, MEASURED, RATIO = 0.97, 512, 1.02
#: Neighbours of a centroid in the graph, the beam of a walk at least, and its width over the lists that nearly all queries open.
DEGREE, BEAM, WIDER = 16, 32, 1.5
#: Lists opened at least for a query that lacks results; each further round opens as many times more.
MORE = 8


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Centres of clusters that hold len(x) / lists rows at most, about."""
    rng, most = np.random.default_rng(seed), max(1.0, 1.25 * len(x) / max(1, lists))
    todo, out = [x], []
    while todo:
        part = todo.pop()
        if len(part) <= most:
            out.append(part.mean(0))
            continue
        ways = int(min(8, max(2, round(len(part) / most)), len(part)))
        near = tiles.kmeans(part, ways, rng)[1]
        parts = [part[near == w] for w in range(ways)]
        if max(map(len, parts)) == len(part):          # equal rows: cut them evenly
            out.append(part.mean(0))
            continue
        todo += [p for p in parts if len(p)]
    return np.array(out)


@dataclass
class CentroidGraph:
    centroids: np.ndarray
    neighbours: np.ndarray          # (lists, degree)
    entries: np.ndarray
    beam: int

    @classmethod
    def build(cls, centroids: np.ndarray, degree: int = DEGREE) -> CentroidGraph:
        n = len(centroids)
        rng = np.random.default_rng(2)
        near = np.zeros((n, min(degree, max(1, n - 1))), np.int64)
        for at in range(0, n, 512):
            c = centroids[at:at + 512]
            d = (centroids ** 2).sum(1) - 2 * c @ centroids.T
            d[np.arange(len(c)), np.arange(at, at + len(c))] = np.inf
            near[at:at + 512] = d.argsort(1)[:, :near.shape[1]]
        # A few far links and a ring keep the graph connected.
        far = rng.integers(0, n, (n, 3))
        ring = (np.arange(n)[:, None] + 1) % n
        return cls(centroids, np.hstack([near, far, ring]), np.unique(rng.integers(0, n, 8)), int(min(n, BEAM)))

    def walk(self, x: np.ndarray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each row and their distances, nearest first (``width`` columns;
        missing ones have an infinite distance)."""
        width, m, n = width or self.beam, len(x), len(self.centroids)
        width = min(width, n)
        norm, rows = (self.centroids ** 2).sum(1), np.arange(m)[:, None]
        seen = np.zeros((m, n + 1), bool)
        seen[:, self.entries] = True
        ids = np.tile(self.entries, (m, 1))
        dist = norm[ids] - 2 * np.einsum("md,mkd->mk", x, self.centroids[ids])
        opened = np.zeros(ids.shape, bool)
        while True:
            # The nearest unopened centroids of each row's beam.
            order = np.argsort(np.where(opened, np.inf, dist), 1)[:, :4]
            pick = np.take_along_axis(ids, order, 1)
            live = ~np.take_along_axis(opened, order, 1) & (pick < n)
            if not live.any():
                break
            np.put_along_axis(opened, order, True, 1)
            new = np.where(live[:, :, None], self.neighbours[np.minimum(pick, n - 1)], n).reshape(m, -1)
            new = np.sort(new, 1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = n
            new[seen[rows, new]] = n
            seen[rows, new] = True
            seen[:, n] = False
            safe = np.minimum(new, n - 1)
            d = np.where(new < n, norm[safe] - 2 * np.einsum("md,mkd->mk", x, self.centroids[safe]), np.inf)
            ids, dist = np.hstack([ids, new]), np.hstack([dist, d])
            opened = np.hstack([opened, new == n])
            keep = np.argsort(dist, 1)[:, :width]
            ids, dist, opened = (np.take_along_axis(a, keep, 1) for a in (ids, dist, opened))
        order = np.argsort(dist, 1)
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        return ids, np.sqrt(np.maximum(dist + (x ** 2).sum(1)[:, None], 0))

    def all(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All centroids and their distances, nearest first."""
        d = np.maximum((self.centroids ** 2).sum(1) - 2 * x @ self.centroids.T + (x ** 2).sum(1)[:, None], 0)
        ids = d.argsort(1)
        return ids, np.sqrt(np.take_along_axis(d, ids, 1))

    def lists_of(self, x: np.ndarray, replicas: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs of the lists that hold each vector."""
        ids, dist = self.walk(x, 16)
        take = np.isfinite(dist) & (dist <= ratio * dist[:, :1] + 1e-12)
        take[:, 0] = True
        take[:, replicas:] = False
        return np.nonzero(take)[0], ids[take]


def build(vectors: DataFrame, dim: int, n: int, k: int) -> tuple[CentroidGraph, float, float]:
    """The centroids' graph, the largest squared norm and the ratio that chooses lists."""
    once = vectors.groupBy("vec_id").agg(F.min("v").alias("v"))          # a hot id is one vector of the sample
    sample = tiles.matrix(once.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("v"), dim)

    def norms(batches):
        for b in batches:
            yield pa.record_batch({"n2": pa.array([float((tiles.matrix(b.column("v"), dim) ** 2).sum(1).max(initial=0))])})

    norm2 = vectors.select("v").mapInArrow(norms, "n2 double").agg(F.max("n2")).head()[0] or 0.0
    sample = sample if len(sample) else np.zeros((1, dim))
    x = extended(sample, norm2)
    graph = CentroidGraph.build(balanced_centroids(x, int(np.clip(-(-n // LIST), 1, min(LISTS, len(x))))))
    ratio, wide = measured_ratio(graph, sample, x, n, k)
    graph.beam = int(min(len(graph.centroids), max(BEAM, WIDER * wide)))
    return graph, norm2, ratio


def measured_ratio(graph: CentroidGraph, sample: np.ndarray, x: np.ndarray, n: int, k: int) -> tuple[float, float]:
    """The ratio at which sampled queries read lists of RECALL of their k best others in the sample, and how many lists
    all but a hundredth of them open then."""
    lists = len(graph.centroids)
    if lists == 1 or len(sample) <= k:
        return float("inf"), float(lists)
    parts = [(at, *graph.lists_of(x[at:at + 1024], REPLICAS, CLOSURE)) for at in range(0, len(x), 1024)]      # a walk holds many centroids a row
    row, of = np.concatenate([at + r for at, r, _ in parts]), np.concatenate([c for _, _, c in parts])
    held = np.full((len(sample), REPLICAS), -1)
    first = np.concatenate([[True], row[1:] != row[:-1]])
    held[row[first], 0] = of[first]
    held[row[~first], 1] = of[~first]
    size = np.bincount(of, minlength=lists) * (n / len(sample))
    rng = np.random.default_rng(3)
    needed, opened = [], []
    for at in np.array_split(rng.permutation(len(sample))[:MEASURED], 16):
        if not len(at):
            continue
        score = sample[at] @ sample.T
        score[np.arange(len(at)), at] = -np.inf
        best = np.argpartition(-score, k - 1, 1)[:, :k]
        ids, dist = graph.all(np.hstack([sample[at], np.zeros((len(at), 1))]))
        base = np.minimum((size[ids].cumsum(1) <= k).sum(1), lists - 1)
        unit = np.maximum(np.take_along_axis(dist, base[:, None], 1), 1e-12)
        by_list = np.full((len(at), lists + 1), np.inf)           # the last column: no further list
        np.put_along_axis(by_list, ids, dist / unit, 1)
        near = held[best]
        needed.append(by_list[np.arange(len(at))[:, None, None], np.where(near < 0, lists, near)].min(2).ravel())
        opened.append(dist / unit)
    ratio = max(RATIO, float(np.quantile(np.concatenate(needed), RECALL)) * (1 + 1e-9))
    return ratio, float(np.quantile((np.concatenate(opened) <= ratio).sum(1), 0.99))


def extended(x: np.ndarray, norm2: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(norm2 - (x ** 2).sum(1), 0))[:, None]])


def search(df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, probe: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the k nearest others found. ``probe``:
    the ratio that chooses lists (measured by default)."""
    spark = df.sparkSession
    vectors, dim = tiles.encode(df, vec_id, vector, zero_ok=False)
    vectors, path = cut(spark, vectors, "ann-vectors")
    graph, norm2, ratio = build(vectors, dim, vectors.count(), k)
    if probe is None:
        probe = ratio
    else:                # how many lists a given ratio opens is not known before
        graph.beam = len(graph.centroids)
    shared = spark.sparkContext.broadcast(graph)

    def post(batches):
        for b in batches:
            x = tiles.matrix(b.column("v"), dim)
            for at in range(0, len(x), 1024):
                part = b.slice(at, 1024)
                rows, lists = shared.value.lists_of(extended(x[at:at + 1024], norm2), REPLICAS, CLOSURE)
                yield pa.record_batch({"cell": pa.array(lists, pa.int32()), "vec_id": part.column("vec_id").take(pa.array(rows)), "v": part.column("v").take(pa.array(rows))})

    lists, lists_path = cut(spark, vectors.mapInArrow(post, "cell int, vec_id long, v binary"), "ann-lists")

    size = np.zeros(len(graph.centroids) + 1, np.int64)          # the last one stands for missing lists
    for r in lists.groupBy("cell").agg(F.count_distinct("vec_id").alias("c")).collect():
        size[r.cell] = r.c

    def ask(least: int):
        """The nearest list (0), the others within the ratio (1), or at least so many, looking at all."""
        def run(batches):
            for b in batches:
                x, floor = tiles.matrix(b.column("v"), dim), b.column("floor").to_numpy()
                for at in range(0, len(x), 512):
                    y = x[at:at + 512]
                    y = np.hstack([y, np.zeros((len(y), 1))])
                    ids, dist = shared.value.all(y) if least > 1 else shared.value.walk(y)
                    if least:
                        # The ratio is to the list that completes k, or to the last one that is to be opened.
                        filled = (size[ids].cumsum(1) <= k).sum(1)
                        base = np.minimum(np.maximum(filled, least - 1), np.isfinite(dist).sum(1) - 1)
                        take = np.isfinite(dist) & (dist <= probe * np.maximum(np.take_along_axis(dist, base[:, None], 1), 1e-12))
                        take[:, 0] = least > 1
                    else:
                        take = np.zeros(ids.shape, bool)
                        take[:, 0] = True
                    rows = at + np.nonzero(take)[0]
                    yield pa.record_batch({"cell": pa.array(ids[take], pa.int32()), "query_id": b.column("query_id").take(pa.array(rows)),
                                           "v": b.column("v").take(pa.array(rows)), "floor": pa.array(floor[rows])})
        return run

    fields = "cell int, query_id long, v binary, floor double"
    queries = vectors.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", F.lit(float("-inf")).alias("floor"))
    near, near_path = cut(spark, tiles.score(lists, queries.mapInArrow(ask(0), fields), dim, k), "ann-near")
    kth = (near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
               .withColumn("r", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") == k)
               .select("query_id", F.col("score").alias("low")))
    rest = queries.drop("floor").join(kth, "query_id", "left").select("query_id", "v", F.coalesce("low", F.lit(float("-inf"))).alias("floor"))
    found, found_path = cut(spark, near.unionByName(tiles.score(lists, rest.mapInArrow(ask(1), fields), dim, k)), "ann-found")
    paths, least, want = [path, lists_path, near_path], MORE, k

    def short() -> DataFrame:
        held = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("held"))
        return queries.join(held, "query_id", "left").filter(F.coalesce("held", F.lit(0)) < want).drop("held")

    lacking = short().head() is not None
    if lacking:          # no query can have more than the other ids of the table
        want = min(k, vectors.select("vec_id").distinct().limit(k + 1).count() - 1)
    while lacking and least < MORE * len(size):
        paths.append(found_path)
        found, found_path = cut(spark, found.unionByName(tiles.score(lists, short().mapInArrow(ask(least), fields), dim, k)), "ann-found")
        least *= MORE
        lacking = short().head() is not None
    for p in paths:
        drop_path(spark, p)
    return tiles.top(found, k)
