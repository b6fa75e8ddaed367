"""Ranking and previous-value operators, native and emulated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_desc(df: DataFrame, partition: Sequence[str], value: str, out: str = "ranking",
              nulls_first: bool = True) -> DataFrame:
    """RANK() over a partition, value descending. ``nulls_first`` follows the
    PostgreSQL default for DESC (Spark's default puts NULLs last)."""
    order = F.col(value).desc_nulls_first() if nulls_first else F.col(value).desc_nulls_last()
    return df.withColumn(out, F.rank().over(Window.partitionBy(*partition).orderBy(order)))


def rank_by_greater_count(df: DataFrame, partition: Sequence[str], value: str,
                          out: str = "ranking") -> DataFrame:
    """``1 + number of rows in the same partition with a strictly larger value``.

    This is the self-join form of ranking (``LEFT JOIN b ON a.p = b.p AND
    b.v > a.v`` then ``1 + COUNT(b.x)``) computed without pairing rows: count
    rows per distinct value, take the running count of larger values over that
    histogram, and join it back on (partition, value). NULL values are never
    counted and rank 1, as in the join form.
    """
    part = list(partition)
    hist = (df.where(F.col(value).isNotNull())
              .groupBy(*part, value).agg(F.count(F.lit(1)).alias("_n")))
    w = (Window.partitionBy(*part).orderBy(F.col(value).desc())
               .rowsBetween(Window.unboundedPreceding, -1))
    greater = hist.select(*part, value, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_greater"))
    j = df.join(greater, on=[*part, value], how="left")
    return j.withColumn(out, (F.lit(1) + F.coalesce(F.col("_greater"), F.lit(0))).cast("bigint")).drop("_greater")


def lag_growth(df: DataFrame, partition: Sequence[str], order: str, value: str,
               prev_col: str = "previous_year", growth_col: str = "yearly_growth") -> DataFrame:
    """Previous *available* row by ``order`` and the difference to it (first row NULL)."""
    w = Window.partitionBy(*partition).orderBy(order)
    prev = F.lag(value).over(w)
    return df.withColumn(prev_col, prev).withColumn(growth_col, F.col(value) - F.col(prev_col))


def offset_join_growth(df: DataFrame, keys: Sequence[str], step_col: str, value: str,
                       prev_col: str = "previous_year", growth_col: str = "yearly_growth",
                       offset: int = 1) -> DataFrame:
    """Previous *calendar* step by an equi-join on ``step - offset`` (not a
    range join: each row meets at most one partner), growth against
    ``COALESCE(prev, 0)``."""
    prev = df.select(*keys, (F.col(step_col) + F.lit(offset)).alias(step_col), F.col(value).alias(prev_col))
    j = df.join(prev, on=[*keys, step_col], how="left")
    return j.withColumn(growth_col, F.col(value) - F.coalesce(F.col(prev_col), F.lit(0)))
