import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from voltcube.llm import pieces
from voltcube.llm.queries import PIECE_MODEL

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.select(*COLUMNS)]
    for _, f in corpus_pipeline.STAGES:
        out.append(f(spark, out[-1], SF).cache())
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "mix", "encode"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language_keeps_clean_documents(stages):
    assert stages[1].exceptAll(stages[0]).count() == 0
    clean = stages[0].filter(F.length("text") > 100).join(stages[0].sparkSession.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 and toxic = 0"), "doc_id")
    assert clean.join(stages[1], "doc_id", "left_anti").count() == 0


def test_lines(stages):
    import hashlib
    want = brute.line_dedup(list(texts(stages[1]).items()))
    got = stages[2].collect()
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in got} == {i: w[2] for i, w in want.items()}
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_copies(stages):
    want = brute.jaccard_components(list(texts(stages[2]).items()))
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c for _, c in want.values()})
    assert stages[3].exceptAll(stages[2]).count() == 0


def test_mix_follows_the_targets(stages):
    size, source, taken = {}, {}, {}
    for r in stages[3].collect():
        size[r.source] = size.get(r.source, 0) + len(brute.words(r.text))
        source[r.doc_id] = r
    copies = {}
    for r in stages[4].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        taken[r.source] = taken.get(r.source, 0) + len(brute.words(r.text))
        assert tuple(r) == tuple(source[r.doc_id])
    assert max(copies.values()) <= 3
    for s, t in brute.targets(size).items():
        assert abs(taken.get(s, 0) - t) <= 3 * max(len(brute.words(r.text)) for r in source.values() if r.source == s)


def test_encode(stages):
    e = pieces.Encoder(pieces.Vocabulary.load(PIECE_MODEL))
    docs = stages[4].select("doc_id", "text").distinct().collect()
    ids = dict(zip((r.doc_id for r in docs), (x.tolist() for x in e.encode([r.text for r in docs])), strict=True))
    got = stages[5].collect()
    assert len(got) == stages[4].count() and all(r.ids == ids[r.doc_id] and r.n_pieces == len(r.ids) and r.intact for r in got)


def test_run_is_the_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF)
    digest = lambda df: sorted((r.doc_id, r.n_pieces, zlib.crc32(str(r.ids).encode())) for r in df.collect())
    assert digest(run) == digest(stages[-1])


def test_edge_rows(spark, tmp_path):
    rows = [(1, None, None, None, None, 1), (2, "", "en", "a", 0, 1), (3, "123", "en", "a", 3, 1), (4, "plain words of text in one line", "en", None, 31, 1),
            (4, "plain words of text in one line", "en", None, 31, 1), (None, "some other words without an id here", "en", "a", 35, 1), (5, "des mots en français " * 3, "fr", "b", 63, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, taken int")
    for table in (df, df.limit(0)):
        now = table
        for name, f in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{name}-{table is df}"
            f(spark, now, SF).write.parquet(path)
            now = spark.read.parquet(path)
            if name != "encode":
                assert now.columns == df.columns
        if table is df:
            assert now.filter("doc_id in (1, 2, 3)").count() == 0
        else:
            assert now.count() == 0


def test_documents_stay_where_no_language_is_named(spark):
    rows = [(i, f"clean words of document {i}", None, "a", 20) for i in range(40)] + [(50, "123 456", None, "a", 7), (51, None, None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == COLUMNS and sorted(r.doc_id for r in kept.collect()) == list(range(40))
