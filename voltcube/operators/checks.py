"""Constraint checks as jobs (Spark does not enforce keys).

Each check returns the violating rows or violation counts; an empty result
(or zero counts) means the constraint holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PRIMARY KEY / UNIQUE: keys occurring more than once (with their count).
    The count is a partial aggregate, so a hot key costs one counter per task."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def orphan_rows(fact: DataFrame, dim: DataFrame, fk: Sequence[str], pk: Sequence[str] | None = None) -> DataFrame:
    """FOREIGN KEY: fact rows whose key has no dimension row. NULL keys are
    not violations (as in SQL)."""
    pk = list(pk or fk)
    d = dim.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct()
    nonnull = None
    for f in fk:
        c = F.col(f).isNotNull()
        nonnull = c if nonnull is None else nonnull & c
    return fact.where(nonnull).join(d, on=list(fk), how="left_anti")


def violation_counts(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """One pass over ``df`` counting rows that break each rule; long output
    (table_name, rule, violations)."""
    aggs = [F.count_if(cond).alias(name) for name, cond in rules.items()]
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("violations"))
                                  for n in rules]))
    return wide.select(stacked.alias("r")).select(F.lit(table).alias("table_name"), "r.rule", "r.violations")


def not_null(c: str) -> Column:
    return F.col(c).isNull()


def max_length(c: str, n: int) -> Column:
    return F.length(c) > n


def out_of_range(c: str, bound: float) -> Column:
    return F.abs(F.col(c).cast("double")) > F.lit(bound)


def column_rules(schema: T.StructType, lengths: Mapping[str, int]) -> dict[str, Column]:
    """NOT NULL, text length and decimal range of every column, as violation conditions."""
    rules = {}
    for f in schema.fields:
        if not f.nullable:
            rules[f"{f.name}_not_null"] = not_null(f.name)
        if f.name in lengths:
            rules[f"{f.name}_length"] = max_length(f.name, lengths[f.name])
        if isinstance(f.dataType, T.DecimalType):
            rules[f"{f.name}_range"] = out_of_range(f.name, 10 ** (f.dataType.precision - f.dataType.scale) - 10 ** -f.dataType.scale)
    return rules


def typed_rules(schema: T.StructType, lengths: Mapping[str, int], raw: Mapping[str, str]) -> dict[str, Column]:
    """The rules of ``column_rules`` for a table that has both the values as they came (``raw``: their column names) and
    those cast to the declared types, where a value that the type cannot hold is NULL: that breaks the range."""
    rules = {}
    for f in schema.fields:
        came = F.col(raw[f.name])
        if not f.nullable:
            rules[f"{f.name}_not_null"] = came.isNull()
        if f.name in lengths:
            rules[f"{f.name}_length"] = max_length(f.name, lengths[f.name])
        if isinstance(f.dataType, T.NumericType):
            rules[f"{f.name}_range"] = came.isNotNull() & F.col(f.name).isNull()
    return rules


def _counted(table: str, rule: str, violations: DataFrame) -> DataFrame:
    return violations.groupBy().agg(F.count(F.lit(1)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations")


def _references(tables: Mapping[str, DataFrame], name: str, fks: Mapping[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """A table with its references looked up, and the rule of each."""
    met, rules = tables[name], {}
    for c, dim in fks.items():
        # The dimension's keys are few and made distinct; an unmet key stays NULL.
        met = met.join(tables[dim].select(F.col(c).alias(f"_{c}")).where(F.col(f"_{c}").isNotNull()).distinct(), F.col(c) == F.col(f"_{c}"), "left")
        rules[f"{c}_references_{dim}"] = F.col(c).isNotNull() & F.col(f"_{c}").isNull()
    return met, rules


def _keys(tables: Mapping[str, DataFrame], name: str, pk: Sequence[str], unique: Sequence[str]) -> list[DataFrame]:
    t = tables[name]
    return [_counted(name, "primary_key", duplicate_keys(t, pk))] + [_counted(name, f"{u}_unique", duplicate_keys(t.where(F.col(u).isNotNull()), [u])) for u in unique]


def constraint_counts(tables: Mapping[str, DataFrame], constraints) -> DataFrame:
    """(table_name, rule, violations) of every constraint of every table:
    column rules and foreign keys in one pass per table, then one count per key
    and unique column. ``constraints``: name -> (schema, primary key, unique
    columns, foreign keys {column: table}) plus text lengths."""
    specs, lengths = constraints
    parts = []
    for name, (schema, pk, unique, fks) in specs.items():
        met, references = _references(tables, name, fks)
        parts += [violation_counts(met, name, column_rules(schema, lengths) | references), *_keys(tables, name, pk, unique)]
    return reduce(DataFrame.unionByName, parts)


def key_counts(tables: Mapping[str, DataFrame], specs, names: Sequence[str]) -> DataFrame:
    """The same for the keys and references alone, of the named tables."""
    parts = []
    for name in names:
        _, pk, unique, fks = specs[name]
        if fks:
            met, references = _references(tables, name, fks)
            parts.append(violation_counts(met, name, references))
        parts += _keys(tables, name, pk, unique)
    return reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame, table: str, key: str, year: str) -> DataFrame:
    """Row count, NULL count of a key column, year range: one aggregate pass."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.count_if(F.col(key).isNull()).cast("bigint").alias("null_keys"),
                  F.min(year).cast("bigint").alias("min_year"),
                  F.max(year).cast("bigint").alias("max_year")).select(F.lit(table).alias("table_name"), "*")
