"""String similarity on character 3-grams, as Spark expressions (no Python on the data path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(c) -> Column:
    """Distinct 3-grams of a string with two blanks in front and one behind
    (the start of a name counts more than its end). An empty string has one."""
    padded = F.concat(F.lit("  "), c, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) + 1), lambda i: F.substring(padded, i, F.lit(3))))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two 3-gram arrays: shared / all distinct grams."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)
