"""Join operators of the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], bool]],
              how: str = "inner") -> DataFrame:
    """Fact to dimensions: ``dims`` holds (dimension, key columns, bounded).

    A dimension marked ``bounded`` has a row count fixed by its definition
    (nations, calendar years, a closed label set) and is broadcast; others are
    left to the planner, which broadcasts at runtime only below its threshold.
    """
    out = fact
    for dim, keys, bounded in dims:
        out = out.join(F.broadcast(dim) if bounded else dim, on=list(keys), how=how)
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column | str,
                  cols: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the values of the first (or last) row by ``order``.

    ``min_by``/``max_by`` over a struct aggregate partially on each task, so a
    hot key costs one running value per task, never a sorted group.
    """
    order_c = F.col(order) if isinstance(order, str) else order
    pick = F.max_by if last else F.min_by
    packed = F.struct(*[F.col(c) for c in cols])
    g = df.groupBy(*keys).agg(pick(packed, order_c).alias("_row"))
    return g.select(*keys, *[F.col("_row")[c].alias(c) for c in cols])


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], bounded: bool = False,
           how: str = "left") -> DataFrame:
    """Dictionary lookup: a left join on a key-unique side."""
    return df.join(F.broadcast(table) if bounded else table, on=list(on), how=how)


def presence(tables: Sequence[DataFrame], keys: Sequence[str], mask: str = "mask") -> DataFrame:
    """Distinct keys of all tables with a bit mask of the tables that have them (bit i: table i). NULL is a key value
    like others, as in EXCEPT. One shuffle of keys, reduced before it."""
    tagged = [t.select(*keys, F.lit(1 << i).cast("bigint").alias(mask)) for i, t in enumerate(tables)]
    return reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(F.bit_or(mask).alias(mask))


def absent(tables: Mapping[str, DataFrame], keys: Sequence[str], of: str, name: str) -> DataFrame:
    """Set differences: keys of table ``of`` that others lack, one row (``name``: the other's) for each."""
    others = [n for n in tables if n != of]
    held = presence([tables[of], *[tables[n] for n in others]], keys, "_mask").where(F.col("_mask").bitwiseAND(1) == 1)
    lacking = [F.when(F.col("_mask").bitwiseAND(1 << i) == 0, F.lit(n)) for i, n in enumerate(others, 1)]
    return held.select(F.explode(F.array_compact(F.array(*lacking))).alias(name), *keys)
