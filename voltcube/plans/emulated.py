"""The questions in their emulated (3NF) form: UNION ALL of one GROUP BY per
level instead of ROLLUP / CUBE / GROUPING SETS, and an equi-join on the
shifted year instead of LAG.

The ranking emulation keeps the meaning of the self join
(``1 + COUNT`` of larger rows in the same year) but computes it from a
per-value histogram, so no pair of rows is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.operators.grouping import cube_levels, rollup_levels, union_of_levels
from voltcube.operators.windows import offset_join_growth, rank_by_greater_count
from voltcube.plans.olap import GSETS, _cd, _yd, infrastructure_named, r6, stock_by_country_year
from voltcube.plans.warehouse import Warehouse


# Q1 ------------------------------------------------------------------------
def rollup_union(w: Warehouse) -> DataFrame:
    """Detail, continent subtotal and grand total from the fact; the NULL
    continent stays (as a group) and there are no zero cells."""
    cols = ["continent", "year"]

    def source(level):
        f = w.ev_market
        if "continent" in level:
            f = f.join(_cd(w, "continent"), "key_c")
        if "year" in level:
            f = f.join(_yd(w, "year"), "key_y")
        return f

    j = w.ev_market.join(_cd(w, "continent"), "key_c").join(_yd(w, "year"), "key_y")
    out = union_of_levels(j, cols, rollup_levels(cols),
                          [F.coalesce(F.sum("ev_sales"), F.lit(0)).cast("bigint").alias("total_ev_sales")],
                          source_for_level=source)
    return out.select("continent", F.col("year").cast("bigint").alias("year"), "total_ev_sales", "grouping_level")


# Q4 ------------------------------------------------------------------------
def rank_selfjoin(w: Warehouse) -> DataFrame:
    r = rank_by_greater_count(stock_by_country_year(w), ["year"], "stock", "ranking")
    return r.select(F.col("year").cast("bigint").alias("year"), "country", r6("stock").alias("stock"), "ranking")


# Q5 ------------------------------------------------------------------------
def cube_union(w: Warehouse) -> DataFrame:
    cols = ["vehicle_type", "powertrain"]

    def source(level):
        f = w.ev_market
        if "vehicle_type" in level:
            f = f.join(F.broadcast(w.vehicle_type_dim), "key_v")
        if "powertrain" in level:
            f = f.join(F.broadcast(w.powertrain_dim), "key_p")
        return f

    full = source(cols)
    out = union_of_levels(full, cols, cube_levels(cols),
                          [F.sum("ev_sales").cast("bigint").alias("total_sales")], source_for_level=source)
    return out.select(*cols, "total_sales", "grouping_level")


# Q7 ------------------------------------------------------------------------
def growth_selfjoin(w: Warehouse) -> DataFrame:
    """Previous *calendar* year by an equi-join on (country key, year - 1)."""
    r = offset_join_growth(infrastructure_named(w), ["key_c"], "year", "ev_charging_points")
    return r.select("country", F.col("year").cast("bigint").alias("year"), "ev_charging_points",
                    "previous_year", "yearly_growth")


# Q9 ------------------------------------------------------------------------
def gsets_union(w: Warehouse) -> DataFrame:
    cols = ["continent", "pandemic_period"]

    def source(level):
        f = w.ev_market
        if "continent" in level:
            f = f.join(_cd(w, "continent"), "key_c")
        if "pandemic_period" in level:
            f = f.join(_yd(w, "pandemic_period"), "key_y")
        return f

    full = source(cols)
    out = union_of_levels(full, cols, GSETS, [F.sum("ev_sales").cast("bigint").alias("sales")],
                          source_for_level=source)
    return out.select(*cols, "sales", "grouping_level")


EMULATED = {
    "rollup_union": rollup_union, "rank_selfjoin": rank_selfjoin, "cube_union": cube_union,
    "growth_selfjoin": growth_selfjoin, "gsets_union": gsets_union,
}

# Pairs of (native, emulated) query keys; the bench reports their time ratio.
PAIRS = {
    "Q1": ("rollup_dense", "rollup_union"),
    "Q4": ("rank_stock", "rank_selfjoin"),
    "Q5": ("cube_sales", "cube_union"),
    "Q7": ("lag_growth", "growth_selfjoin"),
    "Q9": ("gsets_sales", "gsets_union"),
}
