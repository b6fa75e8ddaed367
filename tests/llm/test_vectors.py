import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from voltcube.llm import ann, queries, tiles, topk

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    from voltcube.llm.common import ship
    ship(spark)
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def frame(spark, vectors, repeat=()):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "extra", 0) for i, v in [*vectors.items(), *repeat]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string, cell int")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_exact_topk(spark, table):
    vectors = {r.vec_id: np.floor(64 * np.array(r.embedding, float)).astype(int) for r in table.collect()}
    want = brute.top_k(vectors, score=lambda x, y: int(x @ y))
    assert found(queries.queries()["op8_exact_topk"](spark, SF)) == want


def clustered(n, dim, seed=5, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    return {i: (centres[i % 8] + spread * rng.normal(size=dim)).astype(np.float32) for i in range(n)}


@pytest.mark.parametrize("spread,annulus", [(0.2, 64), (0.2, 2048), (0.001, 32)])
def test_exact_topk_prunes_and_stays_exact(spark, monkeypatch, spread, annulus):
    monkeypatch.setattr(topk, "ANNULUS", annulus)
    vectors = clustered(1500, 8, spread=spread)
    got = found(topk.search(frame(spark, vectors), k=7, every=50))
    want = brute.top_k({i: v.astype(float) for i, v in vectors.items()}, k=7, every=50, score=lambda x, y: float((x * y).sum()))
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}


def test_rings_bound_every_vector():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(500, 6)), rng.normal(size=(20, 6))
    r = topk.Rings(rng.normal(size=(4, 7)), float((x ** 2).sum(1).max()), *[np.zeros(0)] * 3)
    d = r.distances(x, r.extra(x))
    near = d.argmin(1)
    cell = near * 3 + np.minimum(2, d.min(1).astype(int))
    names = np.unique(cell)
    r.pivot = names // 3
    r.low, r.high = (np.array([f(d.min(1)[cell == c]) for c in names]) for f in (np.min, np.max))
    most = r.bounds(q)[1]
    for j, c in enumerate(names):
        assert ((q @ x[cell == c].T).max(1) <= most[:, j]).all()


def test_tiles_split_and_ties(spark, monkeypatch):
    monkeypatch.setattr(tiles, "TILE_VECTORS", 50)
    monkeypatch.setattr(tiles, "TILE_QUERIES", 7)
    vectors = {i: [1, 2, 3] if i % 3 else [i % 5, 1, 0] for i in range(400)}     # a hot group of equal vectors
    want = brute.top_k({i: np.array(v, float) for i, v in vectors.items()}, k=20, every=20, score=lambda x, y: float((x * y).sum()))
    assert found(topk.search(frame(spark, vectors), k=20, every=20)) == want
    assert found(ann.search(frame(spark, {i: v for i, v in vectors.items() if any(v)}), k=20, every=20, probe=99)) == {
        q: r for q, r in brute.top_k({i: np.array(v, float) for i, v in vectors.items() if any(v)}, k=20, every=20, score=lambda x, y: float((x * y).sum())).items()}


@pytest.mark.parametrize("search", [topk.search, ann.search])
def test_what_takes_part(spark, search):
    bad = {1: None, 3: [1, None], 5: [math.nan, 1], 7: [math.inf, 1], 9: [1, 2, 3], 11: []}
    good = {0: [1, 0], 2: [2, 0], 4: [0, 1], 6: [-1, -1], 20: [1, 1]}
    df = frame(spark, good | bad, repeat=[(2, [2, 0]), (None, [1, 1])])
    got = found(search(df, k=20, every=20))
    assert got == brute.top_k({i: np.array(v, float) for i, v in good.items()}, every=20, score=lambda x, y: float(x @ y))
    zero = found(search(frame(spark, good | {8: [0, 0], 40: [0, 0]}), k=20, every=20))
    assert ({8, 40} <= {i for i, _ in zero[0]}) == (search is topk.search) and (40 in zero) == (search is topk.search)
    assert search(df.limit(0), k=20, every=20).count() == 0
    assert search(df.filter("vec_id = 1"), k=20, every=20).count() == 0
    assert found(search(frame(spark, {0: [1, 0]}), k=20, every=20)) == {}


def test_ann_recall(spark, table):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    got = found(queries.queries()["op1_nearest_neighbours"](spark, SF))
    want = brute.top_k(vectors, score=lambda x, y: float((x * y).sum()))
    assert got.keys() == want.keys()
    for q, r in got.items():
        assert all(s == pytest.approx(float(vectors[q] @ vectors[i])) and i != q for i, s in r) and len(r) == 20
        assert r == sorted(r, key=lambda x: (-x[1], x[0]))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_ann_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 40)
    vectors = clustered(3000, 12, spread=0.4)
    got = found(ann.search(frame(spark, vectors), k=10, every=25))
    want = brute.top_k({i: v.astype(float) for i, v in vectors.items()}, k=10, every=25, score=lambda x, y: float((x * y).sum()))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9


def test_the_ratio_follows_the_data():
    """Clustered vectors need few lists; random directions most of them."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    tables = {"random": unit(rng.normal(size=(6000, 32))), "clustered": unit(unit(rng.normal(size=(60, 32)))[rng.integers(0, 60, 6000)] + 0.05 * rng.normal(size=(6000, 32)))}
    found = {}
    for name, x in tables.items():
        y = ann.extended(x, float((x ** 2).sum(1).max()))
        found[name] = ann.measured_ratio(ann.CentroidGraph.build(ann.balanced_centroids(y, 60)), x, y, 6000, 20)
    assert 1.02 <= found["clustered"][0] < found["random"][0] < 1.5
    assert found["clustered"][1] <= 10 < 30 < found["random"][1]
    one = ann.CentroidGraph.build(np.zeros((1, 3)))
    assert ann.measured_ratio(one, np.zeros((5, 2)), np.zeros((5, 3)), 5, 20)[1] == 1


def test_balanced_lists_and_graph():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(4000, 8)) * 0.01, rng.normal(size=(1000, 8))])      # one dense group
    c = ann.balanced_centroids(x, 50)
    sizes = np.bincount(((c ** 2).sum(1) - 2 * x @ c.T).argmin(1), minlength=len(c))
    assert 50 <= len(c) <= 120 and sizes.max() <= 4 * len(x) / 50
    g = ann.CentroidGraph.build(rng.normal(size=(900, 8)))
    g.beam = 64
    q = rng.normal(size=(50, 8))
    ids, dist = g.walk(q)
    exact = np.sqrt(((q[:, None] - g.centroids) ** 2).sum(2))
    assert np.allclose(dist, np.take_along_axis(exact, ids, 1)) and (np.diff(dist, axis=1) >= 0).all()
    near = exact.argsort(1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids[:, :16], near, strict=True)]) > 0.95
    rows, lists = g.lists_of(q, 3, 1.3)
    n = np.bincount(rows, minlength=50)
    assert n.min() >= 1 and n.max() <= 3 and n.max() > 1 and len(set(zip(rows, lists, strict=True))) == len(rows)
    one = ann.CentroidGraph.build(np.zeros((1, 3)))
    assert one.walk(np.ones((2, 3)))[0].tolist() == [[0], [0]]


@pytest.mark.parametrize("search", [topk.search, lambda df, **a: ann.search(df, probe=99, **a)])
def test_repeated_rows_count_once(spark, monkeypatch, search):
    monkeypatch.setattr(tiles, "TILE_VECTORS", 100)
    monkeypatch.setattr(tiles, "TILE_QUERIES", 7)
    vectors = {i: v.astype(float) for i, v in clustered(400, 6).items()}
    hot = [(7, (3 + j % 40 / 40) * vectors[7]) for j in range(200)]           # one id fills many places
    df = frame(spark, vectors, repeat=[*vectors.items(), *hot])
    got = found(search(df, k=20, every=20))
    rows = [(i, v.astype(np.float32).astype(float)) for i, v in [*vectors.items(), *hot]]
    for q in range(0, 400, 20):
        score = {}
        for i, v in rows:
            if i != q:
                score[i] = max(score.get(i, -np.inf), float((rows[q][1] * v).sum()))
        assert got[q] == sorted(score.items(), key=lambda x: (-x[1], x[0]))[:20]


def test_tile_takes_distinct_ids():
    ids = np.repeat(np.arange(40), 3)
    x = np.column_stack([ids + np.tile([0.0, 0.25, 0.25], 40), np.ones(120)])
    q, v, s = tiles.best(ids, x, np.array([39]), np.array([[1.0, 0.0]]), np.array([-np.inf]), 20)
    assert v.tolist() == list(range(38, 18, -1)) and s.tolist() == [i + 0.25 for i in v] and set(q) == {39}


def test_ann_goes_on_until_full(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 40)
    rng = np.random.default_rng(3)
    unit = lambda x: (x / np.linalg.norm(x)).astype(np.float32)
    vectors = {i: unit([*rng.normal(size=12), 0, 0, 0]) for i in range(2000)}
    vectors |= {2000: unit([0] * 12 + [1, 0, 0])}                                                       # a lone vector
    vectors |= {2020 + i: unit([0] * 13 + [1, 1e-4 * i]) for i in range(8)}                             # a few near copies
    vectors |= {2040 + i: unit([0] * 12 + [1, 1, 1]) for i in range(15)}                                # and equal ones
    got = found(ann.search(frame(spark, vectors), k=20, every=20))
    want = brute.top_k({i: v.astype(float) for i, v in vectors.items()}, k=20, every=20, score=lambda x, y: float((x * y).sum()))
    assert got.keys() == want.keys() and all(len(r) == 20 for r in got.values())
    assert {i for i, _ in got[2020][:7]} == set(range(2021, 2028)) and {i for i, _ in got[2040][:14]} == set(range(2041, 2055))
    few = {i: unit(rng.normal(size=6)) for i in range(9)}
    assert {q: len(r) for q, r in found(ann.search(frame(spark, few), k=20, every=2)).items()} == dict.fromkeys(range(0, 9, 2), 8)
