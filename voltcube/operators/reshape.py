"""Long <-> wide reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise_label(label: str) -> str:
    """Column name for a pivot value: trimmed, lower case, blanks to ``_``."""
    return label.strip().lower().replace(" ", "_")


#: Labels that a pivot may find by itself; each becomes a column.
MOST_LABELS = 200


class LabelError(ValueError):
    pass


def discover_labels(df: DataFrame, col: str, most: int = MOST_LABELS) -> list[str]:
    """The values of a label column, in order. More than ``most`` raise: the column is no set of labels then."""
    found = sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect())
    if len(found) > most:
        raise LabelError(f"{col} has more than {most} values, {found[:3]} among them")
    return found


def label_columns(labels: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """A column name per label. Labels that normalise to one name, to none, or to a name that is taken raise."""
    names = [normalise_label(x) for x in labels]
    held = {c.lower(): "a column" for c in taken}
    for label, n in zip(labels, names):
        if not n or n in held:
            raise LabelError(f"label {label!r} would be column {n!r}, which {held.get(n, 'an empty name')!r} has")
        held[n] = label
    return names


def pivot_found(df: DataFrame, index: Sequence[str], pivot_col: str, value_col: str, order: Column | str, most: int = MOST_LABELS) -> DataFrame:
    """``pivot_first`` over whatever labels the data has (one job finds them): columns in the labels' order."""
    labels = discover_labels(df, pivot_col, most)
    if not labels:
        return df.select(*index).limit(0)
    return pivot_first(df, index, pivot_col, labels, value_col, order, label_columns(labels, index))


def pivot_first(df: DataFrame, index: Sequence[str], pivot_col: str, labels: Sequence[str],
                value_col: str, order: Column | str, names: Sequence[str] | None = None) -> DataFrame:
    """Long to wide keeping, per cell, the first non-NULL value in input order.

    Spark rows have no order, so ``order`` carries it (a sortable column or
    struct). Each cell is ``min_by(value, order)`` restricted to its pivot
    value and to non-NULL values: one hash aggregate, partial per task.
    Groups with a NULL index value or with no value at all are dropped, as a
    pivot table does. Every label gets a column, present in the data or not.
    """
    names = list(names) if names else [normalise_label(x) for x in labels]
    o = F.col(order) if isinstance(order, str) else order
    v, pc = F.col(value_col), F.col(pivot_col)
    aggs = [F.min_by(v, F.when((pc == F.lit(lbl)) & v.isNotNull(), o)).alias(n) for lbl, n in zip(labels, names)]
    keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in index])
    g = df.where(keep).groupBy(*index).agg(*aggs)
    return g.where(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names]))


def pivot_sum(df: DataFrame, index: Sequence[str], pivot_col: str, labels: Sequence[str],
              value_col: str, names: Sequence[str] | None = None, fill: float | None = 0.0) -> DataFrame:
    """Long to wide with ``sum`` per cell: one aggregate over the index (one
    shuffle, partial per task) with a conditional sum per label; empty cells
    become ``fill``. Groups with a NULL index value are dropped."""
    names = list(names) if names else [normalise_label(x) for x in labels]
    aggs = [F.sum(F.when(F.col(pivot_col) == F.lit(lbl), F.col(value_col))).alias(n) for lbl, n in zip(labels, names)]
    keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in index])
    g = df.where(keep).groupBy(*index).agg(*aggs)
    return g.fillna(fill, subset=names) if fill is not None else g


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str, val: str) -> DataFrame:
    """Wide to long; NULL values are kept."""
    return df.unpivot(list(ids), list(cols), var, val)


def columns_matching(df: DataFrame, needle: str) -> list[str]:
    """Column names containing ``needle`` (a schema lookup, no job)."""
    return [c for c in df.columns if needle in c]
