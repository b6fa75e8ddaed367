"""The twelve questions in their native form: ROLLUP / CUBE / GROUPING SETS,
window functions, drill-across joins.

Fact tables are reduced to their (country, year) grain before a drill-across
join, so the join is 1:1 on small inputs instead of fanning a country-year
row out over every vehicle x powertrain row. Dimensions (nations, calendar
years, closed label sets) are bounded and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.functions.scalar import exact_mean, gdp_class as gdp_class_expr
from voltcube.operators.grouping import cube_levels, grouping_sets, rollup_levels
from voltcube.operators.windows import lag_growth as lag_growth_op
from voltcube.operators.windows import rank_desc
from voltcube.plans.warehouse import Warehouse


def r6(c):
    """Doubles leave a query rounded to 6 decimals (stable across engines)."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def _cd(w: Warehouse, *cols):
    return F.broadcast(w.country_dim.select("key_c", *cols))


def _yd(w: Warehouse, *cols):
    return F.broadcast(w.year_dim.select("key_y", *cols))


def market_by_country_year(w: Warehouse, *aggs) -> DataFrame:
    """EV market reduced to the (key_c, key_y) grain of the other facts."""
    return w.ev_market.groupBy("key_c", "key_y").agg(*aggs)


# Q1 ------------------------------------------------------------------------
def rollup_dense(w: Warehouse) -> DataFrame:
    """Sales by continent and year with subtotals, on a dense continent x year
    grid. The grid is generated from the bounded dimensions: each year row
    explodes the set of continents (a scalar subquery, computed once). A
    NULL continent is a grid value but matches no country, as in the
    equality join of the star form; its sales are missing from every total."""
    continents = w.country_dim.agg(F.collect_set(F.struct("continent")).alias("cs"))
    grid = (w.year_dim.select("key_y", "year", F.explode(continents.scalar()).alias("c"))
                      .select(F.col("c.continent").alias("continent"), "key_y", "year"))
    countries = w.country_dim.where(F.col("continent").isNotNull()).select("key_c", "continent")
    sales = market_by_country_year(w, F.sum("ev_sales").alias("s"))
    j = (grid.join(F.broadcast(countries), "continent", "left")
             .join(sales, ["key_c", "key_y"], "left"))
    out = grouping_sets(j, ["continent", "year"], rollup_levels(["continent", "year"]),
                        [F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("total_ev_sales")])
    return out.select("continent", F.col("year").cast("bigint").alias("year"), "total_ev_sales", "grouping_level")


# Q2 ------------------------------------------------------------------------
def drill_across_2(w: Warehouse) -> DataFrame:
    j = (w.country_energy.join(w.country_macro, ["key_c", "key_y"])
          .join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y"))
    return j.select("country", F.col("year").cast("bigint").alias("year"),
                    r6("renewable_generation").alias("renewable_generation"),
                    r6("co2_emissions").alias("co2_emissions"))


# Q3 ------------------------------------------------------------------------
def gdp_class(w: Warehouse) -> DataFrame:
    high, medium = w.gdp_cutoffs
    # Partial sums per country-year (scaled to integers), combined exactly.
    m = market_by_country_year(w, F.sum((F.col("ev_sales_share") * 10 ** 6).cast("decimal(38,0)")).alias("si"),
                               F.count("ev_sales_share").alias("n"))
    j = (w.country_macro.select("key_c", "key_y", "gdp").join(m, ["key_c", "key_y"])
          .join(_yd(w, "year"), "key_y")
          .withColumn("gdp_class", gdp_class_expr("gdp", high, medium)))
    g = j.groupBy("year", "gdp_class").agg(exact_mean("si", 6, count="n", prescaled=True).alias("avg_ev_share"))
    return g.select(F.col("year").cast("bigint").alias("year"), "gdp_class", "avg_ev_share")


# Q4 ------------------------------------------------------------------------
def stock_by_country_year(w: Warehouse) -> DataFrame:
    j = w.ev_market.join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y")
    return j.groupBy("year", "country").agg(F.sum("ev_stock").alias("stock"))


def rank_stock(w: Warehouse) -> DataFrame:
    r = rank_desc(stock_by_country_year(w), ["year"], "stock", "ranking")
    return r.select(F.col("year").cast("bigint").alias("year"), "country", r6("stock").alias("stock"),
                    F.col("ranking").cast("bigint").alias("ranking"))


# Q5 ------------------------------------------------------------------------
def _sales_by_labels(w: Warehouse) -> DataFrame:
    return (w.ev_market.join(F.broadcast(w.vehicle_type_dim), "key_v")
                       .join(F.broadcast(w.powertrain_dim), "key_p"))


def cube_sales(w: Warehouse) -> DataFrame:
    cols = ["vehicle_type", "powertrain"]
    out = grouping_sets(_sales_by_labels(w), cols, cube_levels(cols),
                        [F.sum("ev_sales").cast("bigint").alias("total_sales")])
    return out.select(*cols, "total_sales", "grouping_level")


# Q6 ------------------------------------------------------------------------
def period_avg(w: Warehouse) -> DataFrame:
    j = w.ev_market.join(_yd(w, "pandemic_period"), "key_y")
    return j.groupBy("pandemic_period").agg(exact_mean("ev_sales_share", 6).alias("avg_share"))


# Q7 ------------------------------------------------------------------------
def infrastructure_named(w: Warehouse) -> DataFrame:
    return (w.ev_infrastructure.join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y")
             .select("key_c", "country", "year", F.col("ev_charging_points").cast("bigint").alias("ev_charging_points")))


def lag_growth(w: Warehouse) -> DataFrame:
    """LAG over the fact's own keys (key_y numbers the years in order); the names
    are joined to the result, so the window sees three narrow columns."""
    f = w.ev_infrastructure.join(_yd(w, "year"), "key_y").select("key_c", "year", F.col("ev_charging_points").cast("bigint").alias("ev_charging_points"))
    r = lag_growth_op(f, ["key_c"], "year", "ev_charging_points").join(_cd(w, "country"), "key_c")
    return r.select("country", F.col("year").cast("bigint").alias("year"), "ev_charging_points",
                    "previous_year", "yearly_growth")


# Q8 ------------------------------------------------------------------------
def demand_mix(w: Warehouse) -> DataFrame:
    m = (w.ev_market.where(F.col("ev_electricity_demand") > 0)
          .groupBy("key_c", "key_y").agg(F.sum("ev_electricity_demand").alias("d")))
    j = (m.join(w.country_energy, ["key_c", "key_y"])
          .join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y"))
    g = j.groupBy("country", "year").agg(F.sum("d").alias("d"), F.max("renewable_generation").alias("r"),
                                         F.max("fossil_generation").alias("f"))
    return g.select("country", F.col("year").cast("bigint").alias("year"), r6("d").alias("ev_electricity_demand"),
                    r6("r").alias("renewable_generation"), r6("f").alias("fossil_generation"))


# Q9 ------------------------------------------------------------------------
GSETS = [("continent", "pandemic_period"), ("continent",), ("pandemic_period",), ()]


def gsets_sales(w: Warehouse) -> DataFrame:
    j = w.ev_market.join(_cd(w, "continent"), "key_c").join(_yd(w, "pandemic_period"), "key_y")
    cols = ["continent", "pandemic_period"]
    out = grouping_sets(j, cols, GSETS, [F.sum("ev_sales").cast("bigint").alias("sales")])
    return out.select(*cols, "sales", "grouping_level")


# Q10 -----------------------------------------------------------------------
def ratio_percent(w: Warehouse) -> DataFrame:
    e = w.country_energy.where(F.col("electricity_generation") > 0)
    j = e.join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y")
    pct = F.round(F.lit(100) * F.col("renewable_generation") / F.col("electricity_generation"), 2)
    return j.select("country", F.col("year").cast("bigint").alias("year"),
                    pct.cast("double").alias("renewable_percentage"))


# Q11 -----------------------------------------------------------------------
def stock_improvement(w: Warehouse) -> DataFrame:
    j = w.ev_market.join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y")
    g = j.groupBy("country").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"),
                                 (F.max("ev_stock_share") - F.min("ev_stock_share")).alias("improvement"))
    return g.select("country", F.col("first_year").cast("bigint").alias("first_year"),
                    F.col("last_year").cast("bigint").alias("last_year"), r6("improvement").alias("improvement"))


# Q12 -----------------------------------------------------------------------
def drill_across_3(w: Warehouse) -> DataFrame:
    # AVG over the fan-out rows = average weighted by market rows per key.
    m = market_by_country_year(w, F.sum("ev_sales_share").alias("share"), F.count(F.lit(1)).alias("n"))
    j = (m.join(w.country_energy.select("key_c", "key_y", "renewable_generation"), ["key_c", "key_y"])
          .join(w.country_macro.select("key_c", "key_y", "co2_per_capita"), ["key_c", "key_y"])
          .join(_cd(w, "country"), "key_c").join(_yd(w, "year"), "key_y"))

    def wavg(c):
        num = F.sum(F.col(c) * F.col("n"))
        den = F.sum(F.when(F.col(c).isNotNull(), F.col("n")))
        return num.cast("double") / den

    g = j.groupBy("country", "year").agg(F.sum("share").alias("share"),
                                         wavg("renewable_generation").alias("r"), wavg("co2_per_capita").alias("c"))
    return g.select("country", F.col("year").cast("bigint").alias("year"), r6("share").alias("ev_sales_share"),
                    r6("r").alias("renewable_generation"), r6("c").alias("co2_per_capita"))


NATIVE = {
    "rollup_dense": rollup_dense, "drill_across_2": drill_across_2, "gdp_class": gdp_class,
    "rank_stock": rank_stock, "cube_sales": cube_sales, "period_avg": period_avg,
    "lag_growth": lag_growth, "demand_mix": demand_mix, "gsets_sales": gsets_sales,
    "ratio_percent": ratio_percent, "stock_improvement": stock_improvement, "drill_across_3": drill_across_3,
}
