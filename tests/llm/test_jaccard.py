import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from voltcube.llm import jaccard, queries
from voltcube.llm.components import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from voltcube.llm.common import ship
    ship(spark)


def check(spark, docs, **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, node string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df.repartition(6)).collect()}
    assert got == brute.jaccard_components(docs)
    return got


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.queries()["op10_jaccard_join"](spark, SF).collect()}
    assert got == brute.jaccard_components(docs)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def corpus(seed, copies, passage_docs):
    """Near copies around the threshold, chains, a passage that many share, exact copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    docs = []
    base = [word() for _ in range(80)]
    docs += [edited(rng, base, rng.randrange(0, 5)) for _ in range(copies)]
    for n in (6, 9, 25, 120, 700):
        b = [word() for _ in range(n)]
        docs += [" ".join(b), " ".join(b).upper() + "  "] + [edited(rng, b, k) for k in (1, 1, 2, 3)]
    chain = [word() for _ in range(100)]
    for _ in range(8):
        docs.append(" ".join(chain))
        chain = chain[3:] + [word() for _ in range(3)]
    passage = [word() for _ in range(40)]
    docs += [" ".join([word() for _ in range(rng.randrange(2, 60))] + passage) for _ in range(passage_docs)]
    docs += ["", None, " \t\n", "a b", "A  b", "a b c d", "a b c d e", "a b c d e", "\x0ba\x0c b\r"] + [" ".join(base)] * 20
    rng.shuffle(docs)
    return list(enumerate(docs, 3))


@pytest.mark.parametrize("seed,tile,spine,common,frequent", [(1, 2048, 32, 3, 1 << 18), (2, 16, 2, 3, 1 << 18), (3, 8, 1, 10**9, 1)])
def test_links_whatever_the_sizes(spark, monkeypatch, seed, tile, spine, common, frequent):
    for k, v in {"TILE": tile, "SPINE": spine, "COMMON": common, "FREQUENT": frequent}.items():
        monkeypatch.setattr(jaccard, k, v)
    got = check(spark, corpus(seed, 120, 60))
    assert len({c for _, c in got.values()}) < len(got)


def test_small_arrow_batches(spark):
    """Runs of equal tokens, tiles and places that go over many batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        check(spark, corpus(5, 30, 10))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_null_ids_repeats_and_empty(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(5, text), (5, text), (7, text), (None, text), (9, None), (None, ""), (8, "other")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(df).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (7, 3, 5), (None, 3, 5), (9, 0, 9), (None, 0, None), (8, 1, 8)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=str)
    assert kept == sorted([(5, text), (9, None), (None, ""), (8, "other")], key=str)
    assert jaccard.keep_one(df.limit(0)).count() == 0
    assert jaccard.link_components(df.limit(0)).count() == 0


def test_keep_one(spark):
    docs = corpus(9, 40, 20)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, _nr string")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({c for _, c in brute.jaccard_components(docs).values()})


def test_rows_that_share_an_id_go_only_by_likeness(spark):
    a, b, c = "one two three four five six seven", "other words that make up a second text here", "and a third one with words of its own again"
    df = spark.createDataFrame([(1, a, "x"), (1, b, "x"), (1, b, "y"), (None, c, "x"), (None, c, "x"), (None, a, "z"), (2, b, "x"), (3, None, "x"), (3, None, "x")],
                               "doc_id long, text string, _at string")
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, c), (3, None), (3, None)], key=str)


def test_a_cluster_over_many_tiles(spark, monkeypatch):
    """Documents that may all link by their signatures, of which only some do: clusters are cut and met again."""
    monkeypatch.setattr(jaccard, "TILE", 10)
    monkeypatch.setattr(jaccard, "SPINE", 1)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    docs = list(enumerate([edited(rng, base, k) for k in (0, 1, 1, 2, 2, 2, 3, 3, 4) for _ in range(12)]))
    got = check(spark, docs)
    assert len({c for _, c in got.values()}) > 3


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(0, len(a) + 1), replace=False), rng.integers(0, 2**63, rng.integers(0, 500)).astype(np.uint64), a[:1]]))
        pile = jaccard.Pile(np.array([len(a), len(b)]), [jaccard.signature(a), jaccard.signature(b)])
        differ = len(np.setxor1d(a, b))
        assert pile.differing(0, np.array([1]))[0] <= differ and (differ - pile.differing(1, np.array([0]))[0]) % 2 == 0
        both = len(np.intersect1d(a, b))
        assert (both >= jaccard.needed(len(a), len(b))) == (100 * both >= 80 * (len(a) + len(b) - both))
        if both >= jaccard.needed(len(a), len(b)):
            assert pile.possible(0, np.array([1])).tolist() == [1]


def test_shingles_follow_the_words():
    same = [("A b\tC d  e f", "a b c d e F"), ("x", " X\n"), ("", None)]
    assert all((jaccard.shingle_set(a) == jaccard.shingle_set(b)).all() for a, b in same)
    assert len(jaccard.shingle_set("a b c d e f")) == 2 and len(jaccard.shingle_set("a b c d")) == 1
    assert jaccard.shingle_set("a b")[0] != jaccard.shingle_set("ab")[0] and len(jaccard.shingle_set("é É " * 40)) == 2
    assert len(jaccard.shingle_set("a b")) == 1 and len(jaccard.shingle_set("word " * 300_000)) == 1


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(7)
    edges = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 300)] + [(500, 0)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)], "none": []}[shape]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = [(r.node, r.component) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, root(x)) for x in parent)


def test_tiles_of_boilerplate_stay_small(spark, monkeypatch):
    """Documents that share most tokens but do not link: no tile holds all of a token's nodes."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    monkeypatch.setattr(jaccard, "SPINE", 2)
    largest, links = [], jaccard._links

    def spy(tiles, more, partitions):
        largest.append(tiles.groupBy("tile").agg(F.count_distinct("node").alias("c")).agg(F.max("c")).head()[0] or 0)
        return links(tiles, more, partitions)

    monkeypatch.setattr(jaccard, "_links", spy)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(484)]
    docs = [(i, " ".join(base + [f"o{i} {rng.randrange(10**9)}" for _ in range(52)])) for i in range(160)]
    got = check(spark, docs)
    assert len({c for _, c in got.values()}) == len(docs)
    assert max(largest[:2]) > 16 and max(largest) <= 5 * 16


@pytest.mark.parametrize("shingles", [None, 300])
def test_outer_nodes_meet_all_of_like_size_and_no_others(spark, monkeypatch, shingles):
    monkeypatch.setattr(jaccard, "TILE", 8)
    rng = random.Random(6)
    nodes = [(1, i, rng.choice([5, 6, 7, 40, 41, 50, 60, 75, 100, 1000, 1250, 1251]), i % 3 == 0) for i in range(90)]
    tiles = jaccard._meetings(spark.createDataFrame(nodes, "token long, node long, n long, outer boolean"), "token", shingles)
    held = {}
    for r in tiles.collect():
        held.setdefault(r.tile, {})[r.node] = r.n
    met = {(a, b) for t in held.values() for a in t for b in t if a < b}
    for _, a, n, outer in nodes:
        for _, b, m, other in nodes:
            if a < b and 5 * min(n, m) >= 4 * max(n, m) and (outer or other):
                assert (a, b) in met
    assert all(max(t.values()) <= 1.25 ** 2.01 * min(t.values()) for t in held.values())
    assert shingles is None or max(sum(t.values()) for t in held.values() if len(t) > 4) < 12 * shingles


def test_long_sets_are_cut_by_their_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_SHINGLES", 500)
    monkeypatch.setattr(jaccard, "SPINE", 1)
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    check(spark, list(enumerate([edited(rng, base, k) for k in (0, 2, 4, 6, 9) for _ in range(4)])))
