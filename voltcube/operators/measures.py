"""Aggregation that respects measure additivity.

``measure_agg`` picks the legal aggregate for each measure from the schema
metadata and refuses illegal ones when the plan is built (before any job):
a level measure summed over time, or a unit measure summed at all, raises
unless the caller names an explicit override.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.functions.scalar import exact_mean

from voltcube.schema import FLOW, LEVEL, UNIT

AGGS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}


class AdditivityError(ValueError):
    pass


def legal_aggregate(measure: str, additivity: str, group_cols: Sequence[str], time_cols: Sequence[str],
                    requested: str | None = None, allowed: bool = False) -> str:
    """The aggregate to use for ``measure``: the requested one if legal (or
    explicitly allowed), else the default for its additivity class."""
    over_time = not any(t in group_cols for t in time_cols)
    if additivity not in (FLOW, LEVEL, UNIT):
        raise AdditivityError(f"{measure}: unknown additivity {additivity!r}")
    how = requested or {FLOW: "sum", LEVEL: "sum", UNIT: "avg"}[additivity]
    if how not in AGGS:
        raise AdditivityError(f"{measure}: unknown aggregate {how!r}")
    if allowed or how != "sum":
        return how
    if additivity == UNIT:
        raise AdditivityError(f"{measure} is a unit measure and is never summed (allow it explicitly)")
    if additivity == LEVEL and over_time:
        raise AdditivityError(f"{measure} is a level measure: it cannot be summed over time "
                              f"(group by {list(time_cols)}, request another aggregate or allow it)")
    return how


def measure_agg(df: DataFrame, group_cols: Sequence[str], additivity: Mapping[str, str],
                time_cols: Sequence[str] = ("year",), requested: Mapping[str, str] | None = None,
                allow: Sequence[str] = ()) -> DataFrame:
    """Group ``df`` and aggregate each measure in ``additivity`` legally.

    ``requested`` maps a measure to an aggregate name; an illegal request
    raises ``AdditivityError`` when the plan is built, unless the measure is in
    ``allow`` (e.g. the sum of a share, as one of the questions computes)."""
    requested = dict(requested or {})
    aggs: list[Column] = []
    for m, add in additivity.items():
        how = legal_aggregate(m, add, group_cols, time_cols, requested.get(m), m in allow)
        dtype = df.schema[m].dataType
        if how == "avg" and isinstance(dtype, T.DecimalType):
            aggs.append(exact_mean(m, dtype.scale).alias(m))    # exact, order independent
        else:
            aggs.append(AGGS[how](F.col(m)).alias(m))
    return df.groupBy(*group_cols).agg(*aggs)
