"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube.llm import ann, jaccard, langid, linededup, mixing, phrases, pieces, quality, sharding, topk, urlrules, warc, whitening
from voltcube.llm.common import cut, ship, table
from voltcube.session import apply_runtime_conf

SHARDS = 16
#: Folder-independent name of the vocabulary that op3 encodes with; any SentencePiece model's path will do.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20, every=20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_histogram_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes. The text is read once; only ids, sizes and hashes are written and exchanged."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long"), sharding.size_of(F.col("text")).alias("size"),
                       F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       sharding.text_hash(F.col("text")).alias("h"))
    rows, _ = cut(spark, rows, "shard-rows")
    out = sharding.histogram_shard(rows, SHARDS, hash_col="h", size="size")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding gives the text back."""
    vocab = pieces.Vocabulary.load(PIECE_MODEL)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    both = pieces.round_trip(docs, vocab)
    return both.select("doc_id", "n_pieces", "ids", "intact")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return linededup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    rows, _ = cut(spark, docs.select(F.col("doc_id").cast("long"), "source", mixing.n_words(F.col("text")).alias("size")), "mix-rows")
    return mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken")


def held_out(folds: int, out: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == out, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out(5, 0))
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out(4, 2))
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").filter(~held_out(4, 2))
    model = quality.train(docs.select("doc_id", "text"), labels)
    return quality.score(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "score", "predicted")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20, every=20, scale=64.0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast("long").alias("score"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    back = warc.round_trip(pages)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings, fitted on all of them. A deviation beyond 64 bits (of many millions of rows) is null here; the operator's is a decimal."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), most=8)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents", "text", "lang"), least=100, top=2000)


#: Rules (host, path, verdict) that op13 applies; any other table of them will do.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages", "page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_nearest_neighbours, op2_histogram_shard, op3_sentencepiece, op4_line_dedup, op5_mix_sources, op6_language_id, op7_quality,
                              op8_exact_topk, op9_warc, op10_jaccard_join, op11_whitening, op12_phrases, op13_url_rules)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            ship(spark)
            return f(spark, sf_dir)
        run.__name__, run.__doc__ = f.__name__, f.__doc__
        return run
    return {k: wrap(f) for k, f in QUERIES.items()}
