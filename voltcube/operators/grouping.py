"""Multi-level aggregation: native (one Expand + one aggregate) and emulated
(one aggregate per level, combined with UNION ALL).

Both forms return the same columns; ``level_col`` carries the grouping id
(bit i set when the i-th grouping column is rolled up), so a subtotal NULL can
be told apart from a NULL in the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level_id(cols: Sequence[str], level: Sequence[str]) -> int:
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in level)


def rollup_levels(cols: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(cols[:i]) for i in range(len(cols), -1, -1)]


def cube_levels(cols: Sequence[str]) -> list[tuple[str, ...]]:
    n = len(cols)
    out = []
    for mask in range(1 << n):
        out.append(tuple(c for i, c in enumerate(cols) if not mask & (1 << (n - 1 - i))))
    return out


def grouping_sets(df: DataFrame, cols: Sequence[str], levels: Sequence[Sequence[str]],
                  aggs: Sequence[Column], level_col: str | None = "grouping_level") -> DataFrame:
    """Native multi-level aggregate: Spark plans one Expand feeding one
    partial/final hash aggregate, so the input is scanned once."""
    extra = [F.grouping_id(*cols).alias(level_col)] if level_col else []
    levels = [list(lv) for lv in levels]
    if levels == [list(x) for x in rollup_levels(cols)]:
        g = df.rollup(*cols)
    elif sorted(map(tuple, levels)) == sorted(cube_levels(cols)):
        g = df.cube(*cols)
    else:
        g = df.groupingSets(levels, *cols)
    return g.agg(*aggs, *extra)


def union_of_levels(df: DataFrame, cols: Sequence[str], levels: Sequence[Sequence[str]],
                    aggs: Sequence[Column], level_col: str | None = "grouping_level",
                    source_for_level=None) -> DataFrame:
    """Emulated multi-level aggregate: one GROUP BY per level, rolled-up
    columns filled with typed NULLs, combined with UNION ALL.

    ``source_for_level(level)`` may return a narrower input per level (the
    3NF form joins only the dimensions a level needs).
    """
    types = dict(df.dtypes)
    parts = []
    for level in levels:
        src = source_for_level(level) if source_for_level else df
        g = src.groupBy(*level).agg(*aggs) if level else src.agg(*aggs)
        sel = [F.col(c) if c in level else F.lit(None).cast(types[c]).alias(c) for c in cols]
        sel += [c for c in g.columns if c not in cols]
        if level_col:
            sel.append(F.lit(_level_id(cols, level)).cast("bigint").alias(level_col))
        parts.append(g.select(*sel))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
