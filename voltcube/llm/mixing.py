"""Operator 5: mixing sources to target weights by systematic sampling (DataFrame only).

Each source gets a target share of all sizes. Its documents are laid on a line
in the order (size, sub-group, doc_id); each one expects ``target / source_size``
copies. With the prefix sum of the expected copies and one random offset per
source, a document is emitted once per integer boundary its interval crosses.
Because the order follows the size, the sizes taken stay close to the target.

Defined results: null sizes count 0; a null source is a source of its own and
comes last; a source without any size takes nothing; repeated rows are separate
documents; an empty table gives an empty result. Extra columns are carried, and
result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltcube.llm.common import fresh

#: Expected copies are integers in units of 1 / ONE, so prefix sums are exact.
ONE = 1 << 32
#: Rows of one (source, size) that are numbered together, and how many such
#: groups there may be in all (beyond them the groups get larger).
SUB_ROWS, SUB_GROUPS = 256, 100_000

WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _uniform(text: Column) -> Column:
    """A 32-bit integer fixed by the string (portable, so that SQL can repeat it)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, weights=(1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size) rows, an empty string standing for no source.

    Shares are water-filled: sources sorted by ``max_repeat * size / weight`` are
    capped one after another until the level of the rest fits under their caps,
    which is what repeated resharing of the excess converges to. The windows run
    over one row per source."""
    s = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))
    by_name = (F.col("source") == "", F.col("source"))
    nth = F.row_number().over(W.orderBy(*by_name)) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (nth % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("cap", max_repeat * F.col("source_size"))
    order = W.orderBy("ratio", *by_name)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (s.withColumn("ratio", F.col("cap") / F.col("w"))
          .withColumn("total", F.sum("source_size").over(everything))
          .withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
          .withColumn("rest", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
          .withColumn("level", (F.col("total") - F.col("before")) / F.col("rest")))
    fits = F.when(F.col("ratio") >= F.col("level"), F.col("level"))
    s = s.withColumn("level", F.first(fits, ignorenulls=True).over(everything))
    target = F.when(F.col("ratio") < F.col("level"), F.col("cap").cast("double")).otherwise(F.col("w") * F.col("level"))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", size: str = "size",
        weights=(1, 2, 3), max_repeat: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``copies`` and ``taken`` (size times copies).

    Every row stays, with ``copies`` from 0 to ``max_repeat``; see ``emit``. A hot
    source is never one task: rows are numbered within (source, size, sub-group)
    and the groups' offsets come from a prefix sum over the groups."""
    docs = docs.drop("source_size", "target", "copies", "taken")
    src, sz, sub, k, idx, off, rate, u = fresh(docs, "_src", "_sz", "_sub", "_k", "_idx", "_off", "_rate", "_u")
    rows = (docs.withColumn(src, F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
                .withColumn(sz, F.coalesce(F.col(size).cast("long"), F.lit(0))))
    total = rows.count()
    per_group = max(SUB_ROWS, total // SUB_GROUPS)
    # Only (source, size) values with more rows than that are split: at most SUB_GROUPS of them.
    heavy = (rows.groupBy(src, sz).count().filter(F.col("count") > per_group)
                 .select(F.col(src).alias("hs"), F.col(sz).alias("hz"),
                         F.ceil(F.col("count") / per_group).cast("long").alias(k)))
    rows = rows.join(F.broadcast(heavy), (F.col(src) == F.col("hs")) & (F.col(sz) == F.col("hz")), "left").drop("hs", "hz")
    spread = _uniform(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = rows.withColumn(sub, F.coalesce(spread % F.col(k), F.lit(0))).drop(k)

    groups = rows.groupBy(src, sz, sub).agg(F.count("*").alias("n"))
    before = W.partitionBy(src).orderBy(sz, sub).rowsBetween(W.unboundedPreceding, -1)
    groups = groups.withColumn(off, F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    t = source_targets(rows, src, sz, weights, max_repeat)
    groups = groups.join(t.withColumnRenamed("source", "ts"), F.col(src) == F.col("ts")).drop("ts")
    groups = groups.withColumn(rate, F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * ONE + 0.5)).otherwise(0).cast("long"))
    groups = groups.withColumn(u, _uniform(F.concat(F.lit(seed + ":"), F.col(src))))

    rows = rows.join(groups, [src, sz, sub])
    number = F.row_number().over(W.partitionBy(src, sz, sub).orderBy(doc_id)) - 1 + F.col(off)
    rows = rows.withColumn(idx, number.cast("decimal(18,0)"))
    at = lambda i: F.call_function("div", F.col(u) + F.col(rate).cast("decimal(18,0)") * i, F.lit(ONE))
    copies = (at(F.col(idx) + 1) - at(F.col(idx))).cast("int")
    rows = rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col(sz))
    return rows.select(*docs.columns, "source_size", "target", "copies", "taken")


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mixed corpus: each row as often as its ``copies`` say."""
    (c,) = fresh(mixed, "_copy")
    return (mixed.filter(F.col("copies") > 0)
                 .withColumn(c, F.explode(F.sequence(F.lit(1), F.col("copies"))))
                 .select(*columns))
