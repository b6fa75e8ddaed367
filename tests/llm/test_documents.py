import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from voltcube.llm import langid, linededup, mixing, quality, queries, sharding

SF = "/root/testdata/sf0.001"
EDGE = [(0, None, "en", None), (1, "", "en", "a"), (2, "x" * 30 + "\n" + "short\n" + "y" * 20, "en", "a"), (3, "  " + "X" * 30 + "\t\nother line that is here only", None, "b"),
        (4, "x" * 30, "fr", "b"), (4000, "x" * 30 + "\n" + "x" * 30, "fr", None), (6, "é" * 20 + "\n" + "é" * 19, "fr", "c"), (7, "É" * 20 + "\n" + "é" * 20, "fr", "c"),
        (8, "é" * 20, "fr", "c"), (9, "é" * 20 + " ", "fr", "c"), (10, "word " * 40_000, "en", "a"), (11, "x" * 30 + "\r\n\n\n", "en", "a")]


@pytest.fixture(scope="module")
def docs(spark):
    from voltcube.llm.common import ship
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def edge(spark, docs):
    rows = [(i, t, lang, s, len(t or ""), "extra", 1) for i, t, lang, s in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, `_hits` string, size int")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_line_dedup(request, which):
    df = request.getfixturevalue(which)
    out = linededup.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()}
    assert got == brute.line_dedup(pairs(df))
    if which == "edge":
        assert {r.doc_id for r in out.filter("text is null").collect()} == {0}


def test_line_dedup_repeated_and_empty(spark, edge):
    twice = edge.union(edge).unionByName(edge.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("x" * 30)))
    out = linededup.dedup_lines(twice).collect()
    assert len(out) == 2 * len(EDGE) + 1
    assert {r.n_dropped for r in out if r.doc_id is None} == {0} and {r.n_dropped for r in out if r.doc_id == 4000} == {0}
    assert linededup.dedup_lines(edge.limit(0)).count() == 0


@pytest.mark.parametrize("salted", [1 << 20, 0])
def test_line_dedup_keeps_probes_of_a_task_few(spark, monkeypatch, salted):
    """Keys that are not among the most frequent, but of far more probes than a shard takes."""
    for k, v in {"SHARD_PROBES": 64, "SHARDS": 8, "HOT": 2, "SALTED": salted}.items():
        monkeypatch.setattr(linededup, k, v)
    common = [f"a line that many documents have, number {i}" for i in range(3)]
    docs = [(i, "\n".join([*(c for j, c in enumerate(common) if i % (j + 2) == 0), f"own line of the document {i}, it is long", "short"])) for i in range(900)]
    sizes, send = [], linededup._send

    def spy(*args):
        out = send(*args)
        sizes.extend(r["count"] for r in out.groupBy("route").count().collect())
        return out

    monkeypatch.setattr(linededup, "_send", spy)
    out = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in out} == brute.line_dedup(docs)
    assert max(sizes) < 4 * 64 and len(sizes) > 8


def test_perfect_hash_is_minimal_and_rejects():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 50_000).astype(np.uint64))
    mph = linededup.PerfectHash.build(keys)
    assert sorted(mph.slots(keys)) == list(range(len(keys))) and not len(mph.rest)
    h2 = keys * np.uint64(7)
    index = linededup.LineIndex.build(keys, h2, np.full(len(keys), 3), keys.view(np.int64))
    index = linededup.LineIndex.read(index.row(0))
    n, keeper = index.probe(keys, h2)
    assert (n == 3).all() and (keeper == keys.view(np.int64)).all()
    assert not index.probe(keys + np.uint64(1), (keys + np.uint64(1)) * np.uint64(7))[0].any() and not index.probe(keys, h2 + np.uint64(1))[0].any()
    same = np.array([5, 5, 9], np.uint64)      # two lines whose first hash half is equal
    index = linededup.LineIndex.read(linededup.LineIndex.build(same, np.array([1, 2, 3], np.uint64), np.array([4, 5, 6]), np.array([7, 8, 9])).row(0))
    assert index.probe(same, np.array([1, 2, 3], np.uint64))[0].tolist() == [4, 5, 6]
    assert index.probe(same, np.array([3, 3, 4], np.uint64))[0].tolist() == [0, 0, 0]


@pytest.mark.parametrize("which", ["docs", "edge"])
def test_mix(request, which):
    df = request.getfixturevalue(which)
    df = df.withColumn("size", mixing.n_words(F.col("text")))
    rows = mixing.mix(df).collect()
    texts = dict(pairs(df))
    sizes = {r.doc_id: len(brute.words(texts[r.doc_id])) for r in rows}
    assert len(rows) == len(texts) and all(r["size"] == sizes[r.doc_id] for r in rows)
    per = {}
    for r in rows:
        per[r.source] = per.get(r.source, 0) + r["size"]
    want = brute.targets(per)
    for r in rows:
        assert r.source_size == per[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
    if which == "docs":
        for s in per:
            assert abs(sum(r.taken for r in rows if r.source == s) - want[s]) <= 3 * max(r["size"] for r in rows if r.source == s)
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in rows}
    assert mixing.emit(mixing.mix(df), df.columns).count() == sum(r.copies for r in rows)


def test_mix_hot_group_and_empty(spark, edge):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"), F.lit(7).alias("size"))
    out = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= 7 and r.most <= 3 for r in out)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix(edge.withColumn("size", F.lit(None).cast("long"))).agg(F.sum("taken")).head()[0] == 0


def check_shards(rows, shards, tolerance=0.002, largest=None):
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    largest = largest or max(r["size"] for r in rows)
    for s in range(shards):
        assert abs(sum(r["size"] for r in by.get(s, [])) - total / shards) <= 2 * max(tolerance * total / shards, largest)


def test_shards(spark):
    rows = queries.queries()["op2_histogram_shard"](spark, SF).collect()
    texts = dict(pairs(spark.read.parquet(f"{SF}/documents.parquet")))
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))
    check_shards(rows, 16)


def test_shards_are_those_of_a_full_sort(spark):
    """Sorted by (hash, id) the shards follow each other, cut where the bytes of all before come nearest to equal parts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.selectExpr("doc_id + 100000", "text")).withColumn("h", sharding.text_hash(F.col("text"))).withColumn("size", sharding.size_of(F.col("text")))
    rows = sorted(sharding.histogram_shard(docs, 8, hash_col="h", size="size", tolerance=0.0001).collect(), key=lambda r: (r.h, r.doc_id))
    shards = [r.shard for r in rows]
    assert shards == sorted(shards)
    total, ends, below = sum(r["size"] for r in rows), {}, 0
    for r in rows:
        below += r["size"]
        ends[r.shard] = below
    for i in range(1, 8):
        ideal, at = total * i // 8, max((e for s, e in ends.items() if s < i), default=0)
        nearest, here = None, 0
        for r in rows:
            nearest = min(nearest if nearest is not None else ideal, abs(here - ideal), abs(here + r["size"] - ideal))
            here += r["size"]
        assert abs(at - ideal) <= nearest + max(1, int(0.0001 * total / 8))


def test_shards_hot_group_nulls_and_empty(spark, edge):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"), F.lit("x").alias("_run"))
    df = df.withColumn("size", sharding.size_of(F.col("text"))).withColumn("h", sharding.text_hash(F.col("text")))
    rows = sharding.histogram_shard(df, 16, hash_col="h", size="size").collect()
    check_shards(rows, 16)
    hot = {r.shard for r in rows if r.text == "same"}
    assert max(hot) - min(hot) + 1 == len(hot) and len(hot) >= 4       # neighbours, split only where the bytes ask for it
    small = edge.withColumn("size", sharding.size_of(F.col("text"))).withColumn("h", sharding.text_hash(F.col("text")))
    assert sharding.histogram_shard(small.union(small), 4, hash_col="h", size="size").count() == 2 * len(EDGE)
    assert sharding.histogram_shard(small.limit(0), 4, hash_col="h", size="size").count() == 0


def test_language(spark, edge):
    out = queries.queries()["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out and r.lang]
    assert len(held) > 20 and np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    model = langid.train(edge)
    got = {r.doc_id: r for r in langid.predict(edge, model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[0].score == 0 and got[8].lang_pred == "fr" and got[10].lang_pred == "en"
    assert {r.lang_pred for r in langid.predict(edge, langid.train(edge.limit(0))).collect()} == {"und"}
    assert model.score(["123 !!", None, "¿?"])[0] == ["und"] * 3


def test_language_scores_are_those_of_the_formula():
    rng = np.random.default_rng(0)
    m = langid.LanguageModel(["a", "b"], np.log(rng.random((3 << 16, 2))), np.log([0.5, 0.5]))
    text = "Some words, and Ébène"
    from voltcube.llm import chars
    p = chars.letter_points(text)
    assert "".join(map(chr, p)) == " some words and ébène "
    like = m.prior + sum(m.log_prob[(k << 16) + chars.ngram_buckets(p, n, 16)].sum(0) for k, n in enumerate((1, 2, 3)))
    lang, score = m.score([text])
    assert lang == [m.langs[like.argmax()]] and score[0] == pytest.approx(1 / np.exp(like - like.max()).sum())
    long = text * 80_000                         # over one piece
    assert m.score([long, text])[0][1] == lang[0]


def test_language_counts_are_those_of_plain_strings(spark):
    """Every n-gram of " words between blanks ", counted as a string and hashed by itself."""
    from collections import Counter

    from voltcube.llm import chars
    texts = [("en", "The cat, the CAT! 12 sat"), ("en", "a"), ("fr", "Été\u00a0déjà--vu"), ("fr", None), (None, "none"), ("en", "The cat, the CAT! 12 sat")]
    df = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    model = langid.train(df, bits=10, smoothing=0.5)
    assert model.langs == ["en", "fr"] and np.allclose(np.exp(model.prior), [0.75, 0.25])
    count = {"en": Counter(), "fr": Counter()}
    for g, t in texts:
        if g and t:
            s = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
            for k, n in enumerate(model.orders):
                for i in range(len(s) - n + 1):
                    bucket = int(chars.ngram_buckets(np.array([ord(c) for c in s[i:i + n]], np.uint32), n, 10)[0])
                    count[g][k << 10 | bucket] += 1
    for k in range(3):
        used = len({b for c in count.values() for b in c if b >> 10 == k})
        for j, g in enumerate(model.langs):
            whole = sum(v for b, v in count[g].items() if b >> 10 == k)
            for b in range(k << 10, (k + 1) << 10):
                assert abs(np.exp(model.log_prob[b, j]) - (count[g][b] + 0.5) / (whole + 0.5 * used)) < 1e-12
    empty = langid.train(df.limit(0))
    assert empty.langs == [] and langid.predict(df.limit(0), model).count() == 0


def test_many_languages_are_counted_in_turns_or_refused(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"{'abcde'[i % 5]}{i % 3} word", f"l{i % 5}") for i in range(60)], "doc_id long, text string, lang string").coalesce(1)
    whole = langid.train(df, bits=10)
    monkeypatch.setattr(langid, "HELD_LANGS", 2)
    turns = langid.train(df, bits=10)
    assert turns.langs == whole.langs and np.array_equal(turns.log_prob, whole.log_prob) and np.array_equal(turns.prior, whole.prior)
    monkeypatch.setattr(langid, "MAX_LANGS", 4)
    with pytest.raises(langid.TooManyLanguages):
        langid.train(df, bits=10)


def test_letters_of_any_plane():
    from voltcube.llm import chars
    text = "A\U0001F600b \U00010400\U0001F600\U0001F601 9z"
    assert "".join(map(chr, chars.letter_points(text))) == " a b \U00010428 z "
    assert chars.letter_points("").tolist() == chars.letter_points("\U0001F600").tolist() == [32]


def test_quality_descent_follows_the_gradient():
    """The steps of the descent against a plain version: softmax of the layer on the mean vector, cross entropy."""
    rng = np.random.default_rng(5)
    rows = [(np.sort(rng.choice(8, 3, replace=False)).astype(np.int32), np.array([0.5, 0.25, 0.25], np.float32), int(y)) for y in (0, 1, 1, 0)]
    got = quality.sgd(rows, bits=3, dim=4, epochs=3, rate=0.3, seed=9)
    rng = np.random.default_rng(9)
    vectors = rng.uniform(-1 / 4, 1 / 4, (8 + quality.PAIRS, 4)).astype(np.float32).astype(float)
    layer, step = np.zeros((4, 2)), 0

    def loss(v, w, row):
        z = (row[1].astype(float) @ v[row[0]]) @ w
        return np.log(np.exp(z).sum()) - z[row[2]]

    for _ in range(3):
        for i in rng.permutation(4):
            lr, e = 0.3 * (1 - step / 12), 1e-6
            step += 1
            dv, dw = np.zeros_like(vectors), np.zeros_like(layer)
            for grad, x in ((dv, vectors), (dw, layer)):
                for at in np.ndindex(*x.shape):
                    held = x[at]
                    x[at] = held + e
                    up = loss(vectors, layer, rows[i])
                    x[at] = held - e
                    grad[at] = (up - loss(vectors, layer, rows[i])) / (2 * e)
                    x[at] = held
            vectors -= lr * dv
            layer -= lr * dw
    assert np.allclose(got, vectors @ (layer[:, 1] - layer[:, 0]), atol=1e-4)


def test_quality(spark, edge):
    out = queries.queries()["op7_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    labels = spark.createDataFrame([(10, 1), (10, 0), (6, 0), (None, 1), (2, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score(edge, quality.train(edge, labels)).collect()}
    assert got[0].score == got[1].score == 0.5 and len(got) == len(EDGE)
    assert {r.score for r in quality.score(edge, quality.train(edge, labels.limit(0))).collect()} == {0.5}


def test_quality_learns_from_one_row_of_a_document_and_a_bounded_sample(spark):
    docs = spark.range(3000).selectExpr("1L as doc_id", "concat('some text of number ', id) as text").union(
        spark.createDataFrame([(2, "bad bad bad bad"), (3, None), (4, "a clean text of several words")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 1)], "doc_id long, quality int")
    seen = []
    real = quality.sgd
    try:
        quality.sgd = lambda rows, **options: seen.append([len(b) for b, _, _ in rows]) or real(rows, **options)
        quality.train(docs, labels)
        quality.train(docs, labels, most=seen[0][0])
        empty = quality.train(docs.limit(0), labels)
    finally:
        quality.sgd = real
    assert len(seen[0]) == 3 and len(seen[1]) < 3 and seen[2] == []
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5} and quality.score(docs.limit(0), empty).count() == 0


def test_quality_features_of_long_texts_equal_those_of_their_pieces():
    text = "alpha beta\n" * 150_000
    pieces = list(quality.pieces_of(text))
    assert len(pieces) > 1 and "".join(pieces) == text
    assert len(list(quality.pieces_of("x" * 3_000_000))) == 3 and list(quality.pieces_of("")) == []
