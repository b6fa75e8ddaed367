"""Comparison of two variants of each query from a run-timing table
(query_id, variant, total_ms, planning_ms): mean per variant with failed runs
(NULL metrics) skipped, the A/B ratio (NULL when B's mean is 0) and the
slowest run. One grouped aggregate, conditional per variant. Times count in
whole microseconds, so the means do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.functions.scalar import exact_mean
from voltcube.plans.olap import r6


def summarize_timings(t: DataFrame, a: str = "A", b: str = "B") -> DataFrame:
    exact = {f"{m}_{v}": F.when(F.col("variant") == x, F.col(f"{m}_ms").cast("decimal(18,3)"))
             for m in ("total", "planning") for v, x in (("a", a), ("b", b))}
    g = (t.withColumns(exact).groupBy("query_id")
          .agg(*[exact_mean(c, 3, out_scale=6).alias(c) for c in exact], F.max("total_ms").alias("mx")))
    return g.select("query_id", F.col("total_a").alias("a_total_ms"), F.col("total_b").alias("b_total_ms"),
                    r6(F.try_divide(F.col("total_a"), F.col("total_b"))).alias("ratio"),
                    F.col("planning_a").alias("a_planning_ms"), F.col("planning_b").alias("b_planning_ms"),
                    r6("mx").alias("max_total_ms"))
