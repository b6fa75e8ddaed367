"""Connected components of a links table, by alternating stars (DataFrame only).

A large star hangs each node's larger neighbours on its smallest neighbour, a small star
does the same with the smaller ones; after a few rounds every node hangs on the smallest
node of its component. Each round's links are written, so a lost executor rereads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.llm.common import cut, drop_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star over (a, b) links with a > b."""
    if large:
        edges = edges.union(edges.select("b", "a"))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = edges.join(least, F.col("a") == F.col("n"))
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a, b) of longs touches; a component is its smallest node."""
    spark = edges.sparkSession
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path = cut(spark, now, "links")
    state = None
    while True:
        check = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).head()
        if (check.n, check.h) == state or not check.n:
            break
        state = (check.n, check.h)
        now, new = cut(spark, _star(_star(now, True), False), "links")
        drop_path(spark, path)
        path = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
