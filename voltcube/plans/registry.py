"""Query registry: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltcube.plans.cleaning_queries import CLEANING
from voltcube.plans.emulated import EMULATED
from voltcube.plans.model_queries import MODEL
from voltcube.plans.olap import NATIVE
from voltcube.plans.warehouse import Warehouse
from voltcube.session import apply_runtime_conf

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_warehouse(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(Warehouse.load(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _with_conf(fn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {}
    for k, fn in {**NATIVE, **EMULATED}.items():
        q[k] = _on_warehouse(fn)
    for k, fn in {**CLEANING, **MODEL}.items():
        q[k] = _with_conf(fn)
    return q
