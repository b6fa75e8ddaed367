"""The training-data pipeline: five stages over ``documents``, each written and reread.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and, but for
the last, returns the columns of ``documents``. All of them accept empty tables, nulls in any
column, repeated rows and extra columns (kept); the docstrings of the operators define the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube.llm import jaccard, langid, linededup, mixing, pieces, queries
from voltcube.llm.common import fresh, ship
from voltcube.session import apply_runtime_conf, scratch_path

#: A document goes if its language is undetermined or less sure than this.
SURE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: keeps documents whose language is recognised. The model learns from all of the stage's rows that
    name their language; where none does, no document is rejected that has a letter."""
    ship(spark)
    model = langid.train(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.predict(docs, model)
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= SURE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: drops repeated lines; a document that loses them all stays, with an empty text. ``n_chars`` follows the text."""
    ship(spark)
    out = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near copies (five-word shingles, similarity 0.8) stays."""
    ship(spark)
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix takes them (0 to 3 times)."""
    (size,) = fresh(docs, "_size")
    mixed = mixing.mix(docs.withColumn(size, mixing.n_words(F.col("text"))), size=size)
    return mixing.emit(mixed, docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: piece ids of every text."""
    ship(spark)
    out = pieces.round_trip(docs.select("doc_id", "text"), pieces.Vocabulary.load(queries.PIECE_MODEL))
    return out.select("doc_id", "n_pieces", "ids", "intact")


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("mix", mix), ("encode", encode)]

#: Naive Bayes and piece merges have no SQL form; the tests compare with plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written under the shared folder and reread."""
    apply_runtime_conf(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
