"""Cleaning flows: long EV table -> market and infrastructure tables, World
Bank unpivot, CO2 and energy tables with a second source patched in.

Name resolution works on the distinct names only and is joined back; pivots
pass their value lists explicitly; lookups are left joins on key-unique sides.
The filtered and resolved tables that every flow reads, and the four clean
tables, are written once per input version through a ``VersionedStore``
(``Cleaning.load``); all cleaning keys and the model read them from there.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube import params as P
from voltcube.functions.scalar import band, ieee_divide, nan_to_null, ne_keep_null, not_in_keep_null, zero_if_invalid
from voltcube.operators.joins import first_per_key, lookup
from voltcube.operators.reshape import columns_matching, pivot_first, pivot_sum, unpivot_columns
from voltcube.operators.resolve import STEP_NAMES, resolve_exact, resolve_names
from voltcube.plans.roles import ENERGY_MEASURES, Roles
from voltcube.plans.stored import at_once, read_or_publish
from voltcube.sources.store import Load

# Input order of the long EV table (unique per row): "first" rules follow it.
RAW_EV_ORDER = ("region", "year", "mode", "powertrain", "parameter", "dup")

# The year a pivoted row belongs to is an index, so within it rows follow their sequence.
SOURCE_ORDER = "seq"


def step_name(step_col: str = "step"):
    expr = None
    for k, v in STEP_NAMES.items():
        expr = F.when(F.col(step_col) == k, F.lit(v)) if expr is None else expr.when(F.col(step_col) == k, F.lit(v))
    return expr


class Cleaning:
    """The flows, lazily. ``Cleaning.load`` gives the stored tables instead."""

    #: What ``load`` stores: shared intermediates, then the four clean tables.
    TABLES = ("name_map", "ev_filtered", "resolved_names", "clean_long", "wb", "market_clean", "infra_clean", "co2_clean", "energy_clean")

    def __init__(self, roles: Roles):
        self.r = roles
        self.p = roles.p

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str, roles: Roles | None = None) -> "Cleaning":
        """Flows whose tables are read from the store; built and published
        first where this input version has none."""
        c = cls(roles or Roles(spark, sf_dir))

        for name, df in read_or_publish(c.r, "clean", cls.TABLES, lambda load: cls.write(load, c.r)).items():
            c.__dict__[name] = df           # takes the place of the cached property
        return c

    #: The tables in the order they are written in; those of a step do not depend on each other.
    STEPS = (("name_map", "ev_filtered", "wb"), ("resolved_names",), ("clean_long",), ("market_clean",), ("infra_clean", "co2_clean", "energy_clean"))

    @classmethod
    def write(cls, load: Load, roles: Roles) -> None:
        """Write every table once; later ones are made from those read back."""
        roles.prepare()
        made = cls(roles)
        made._load = load
        for step in cls.STEPS:
            at_once([partial(getattr, made, name) for name in step])

    _load: Load | None = None

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        """While the tables are written: the table as written, so that the flows that share it do not derive it again."""
        return self._load.write(name, df) if self._load else df

    def _bands(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"half_decade": band("year", self.p.half_decade_bands),
                               "pandemic_period": band("year", self.p.pandemic_bands)})

    # -- reference name table (U3) ------------------------------------------
    @cached_property
    def name_map(self) -> DataFrame:
        """Name -> ISO from the CO2 table, then the energy table; for a name in
        both, the energy entry wins. ``seq`` is the position of the name's first
        appearance (CO2 names first), the order name lookups iterate in."""
        r = self.r
        co2 = r.raw_co2.select(F.col("country").alias("name"), "iso_code").where(F.col("iso_code").isNotNull())
        energy = r.energy_primary.select(F.col("country").alias("name"), "iso_code").where(F.col("iso_code").isNotNull())
        # Both files are sorted by country name.
        pos = lambda src: F.struct(F.lit(src).alias("src"), F.col("name").alias("at"))
        u = co2.select("name", "iso_code", pos(0).alias("pos")).unionByName(energy.select("name", "iso_code", pos(1).alias("pos")))
        last = first_per_key(u, ["name"], "pos", ["iso_code"], last=True)
        first = u.groupBy("name").agg(F.min("pos").alias("seq"))
        return self._cut(last.join(first, "name"), "name_map")

    @cached_property
    def candidates(self) -> DataFrame:
        return self.name_map.select(F.col("name").alias("cand"), F.col("iso_code").alias("iso"), "seq")

    @cached_property
    def continent_map(self) -> DataFrame:
        """ISO -> continent, first row per ISO code (mapping order = key order)."""
        cd = self.r.country_dim.where(F.col("iso_code").isNotNull())
        return first_per_key(cd, ["iso_code"], "key_c", ["continent", "continent_code"])

    # -- C1: long EV table -------------------------------------------------
    @cached_property
    def ev_filtered(self) -> DataFrame:
        lo, hi = self.p.study_years
        raw = self.r.raw_ev
        return self._cut(raw.where((F.col("category") == P.HISTORICAL_CATEGORY) & F.col("year").between(lo, hi))
                            .where(not_in_keep_null("region", P.AGGREGATE_REGIONS)), "ev_filtered")

    @cached_property
    def raw_names(self) -> DataFrame:
        """Distinct names to resolve (one row per spelling, not per data row)."""
        return self.ev_filtered.select(F.col("region").alias("name")).distinct()

    @cached_property
    def resolved_names(self) -> DataFrame:
        return self._cut(resolve_names(self.raw_names, self.candidates), "resolved_names")

    @cached_property
    def exact_names(self) -> DataFrame:
        return resolve_exact(self.raw_names, self.candidates)

    @cached_property
    def clean_long(self) -> DataFrame:
        res = self.resolved_names.select(F.col("name").alias("region"), "iso_code", "country")
        j = self.ev_filtered.join(res, "region")   # unresolved names drop out
        j = j.where(not_in_keep_null("parameter", P.UNWANTED_PARAMETERS))
        return self._cut(j.select("region", "country", "iso_code", "year", "mode", "powertrain", "parameter",
                                  "dup", "value"), "clean_long")

    # -- F4: split -----------------------------------------------------------
    @cached_property
    def infra_long(self) -> DataFrame:
        return self.clean_long.where(F.col("parameter") == P.CHARGING_PARAMETER)

    @cached_property
    def vehicle_long(self) -> DataFrame:
        return self.clean_long.where(ne_keep_null("parameter", P.CHARGING_PARAMETER))

    # -- World Bank (A13, X5, X6, A11) ---------------------------------------
    @cached_property
    def wb_long(self) -> DataFrame:
        rm = self.r.raw_macro.where(F.col("iso_code").isNotNull())
        year_cols = columns_matching(rm, "YR")
        long = unpivot_columns(rm, ["iso_code", "series_code", SOURCE_ORDER], year_cols, "year_str", "value_str")
        return long.select("iso_code", "series_code", SOURCE_ORDER,
                           F.split(F.trim("year_str"), r"\s+")[0].cast("int").alias("year"),
                           F.col("value_str").try_cast("double").alias("value"))

    @cached_property
    def wb(self) -> DataFrame:
        return self._cut(pivot_first(self.wb_long, ["iso_code", "year"], "series_code",
                                     [P.SERIES_POPULATION, P.SERIES_GDP], "value", SOURCE_ORDER,
                                     ["population_wb", "gdp_wb"]), "wb")

    # -- C2 + C9: infrastructure ------------------------------------------------
    @cached_property
    def infra_clean(self) -> DataFrame:
        w = pivot_sum(self.infra_long, ["country", "iso_code", "year"], "powertrain",
                      [P.FAST_LABEL, P.SLOW_LABEL], "value", ["fast_charging_points", "slow_charging_points"])
        w = w.withColumn("ev_charging_points", F.col("fast_charging_points") + F.col("slow_charging_points"))
        w = lookup(self._bands(w), self.continent_map, ["iso_code"])
        # C9: chargers per EV; a year without stock has none.
        stock = self.market_clean.groupBy("iso_code", "year").agg(F.sum("ev_stock").alias("total_stock"))
        w = lookup(w, stock, ["iso_code", "year"])
        w = w.withColumn("charging_points_per_ev", zero_if_invalid(ieee_divide("ev_charging_points", "total_stock")))
        return self._cut(w.select("country", "iso_code", "continent", "continent_code", "year", "half_decade", "pandemic_period",
                                  "ev_charging_points", "fast_charging_points", "slow_charging_points", "charging_points_per_ev"), "infra_clean")

    # -- C3 + C6: market ----------------------------------------------------
    @cached_property
    def market_clean(self) -> DataFrame:
        names = ["ev_sales", "ev_stock", "ev_sales_share", "ev_stock_share", "ev_electricity_demand"]
        w = pivot_first(self.vehicle_long, ["country", "iso_code", "year", "mode", "powertrain"], "parameter",
                        P.MARKET_PARAMETERS, "value", F.struct(*RAW_EV_ORDER), names)
        w = w.fillna(0.0, subset=names).withColumnRenamed("mode", "vehicle_type")
        w = lookup(self._bands(w), self.continent_map, ["iso_code"])
        # C6: population and GDP from the second source only, no fallback.
        w = lookup(w, self.wb.select("iso_code", "year", F.col("population_wb").alias("population"),
                                     F.col("gdp_wb").alias("gdp")), ["iso_code", "year"])
        return self._cut(w.select("country", "iso_code", "continent", "continent_code", "year", "half_decade", "pandemic_period",
                                  "vehicle_type", "powertrain", *names, "population", "gdp"), "market_clean")

    # -- CO2 table (P1, P2, P5, F1, F3, C5, C7) ------------------------------
    @cached_property
    def co2_selected(self) -> DataFrame:
        lo, hi = self.p.study_years
        co2 = self.r.raw_co2.dropna(subset=["iso_code"]).where(F.col("year").between(lo, hi))
        co2 = co2.withColumnsRenamed({"co2": "co2_emissions", "primary_energy_consumption": "energy_consumption"})
        return co2.select("country", "iso_code", "year", "population", "gdp", "co2_emissions", "co2_per_capita", "co2_per_gdp",
                          "oil_co2", "oil_co2_per_capita", "coal_co2", "coal_co2_per_capita", "co2_per_unit_energy", "energy_consumption")

    @cached_property
    def co2_override(self) -> DataFrame:
        """C5: the second source wins, the table's own value is the fallback."""
        j = lookup(self.co2_selected, self.wb, ["iso_code", "year"])
        return (j.withColumn("population", F.coalesce("population_wb", "population"))
                 .withColumn("gdp", F.coalesce("gdp_wb", "gdp"))
                 .drop("population_wb", "gdp_wb"))

    @cached_property
    def co2_clean(self) -> DataFrame:
        """C7: ratios recomputed after the override (NaN/Inf to NULL as loaded)."""
        c = self.co2_override
        c = c.withColumns({
            "co2_per_capita": nan_to_null(ieee_divide(F.col("co2_emissions") * 1e6, F.col("population"))),
            "co2_per_gdp": nan_to_null(ieee_divide(F.col("co2_emissions") * 1e9, F.col("gdp"))),
            "oil_co2_per_capita": nan_to_null(ieee_divide(F.col("oil_co2") * 1e6, F.col("population"))),
            "coal_co2_per_capita": nan_to_null(ieee_divide(F.col("coal_co2") * 1e6, F.col("population"))),
        })
        c = lookup(self._bands(c), self.continent_map, ["iso_code"])
        return self._cut(c.select("country", "iso_code", "continent", "continent_code", "year", "half_decade", "pandemic_period", "population", "gdp",
                                  "co2_emissions", "co2_per_capita", "co2_per_gdp", "oil_co2", "oil_co2_per_capita", "coal_co2", "coal_co2_per_capita",
                                  "co2_per_unit_energy", "energy_consumption"), "co2_clean")

    # -- Energy table (C4, C5) ------------------------------------------------
    @cached_property
    def generation_secondary(self) -> DataFrame:
        g = self.r.raw_generation.where(F.col("area_type") == P.COUNTRY_AREA_TYPE)
        labels = [s for s, _ in P.GENERATION_SOURCES]
        names = [f"{c}_secondary" for _, c in P.GENERATION_SOURCES]
        return pivot_first(g, ["iso_code", "year"], "source", labels, "generation", SOURCE_ORDER, names)

    @cached_property
    def energy_clean(self) -> DataFrame:
        """C4: the table's own value wins; the second source fills its NULLs in
        all twelve patched columns. C5: population and GDP as in the CO2 table."""
        lo, hi = self.p.study_years
        e = self.r.energy_primary.where(F.col("iso_code").isNotNull() & F.col("year").between(lo, hi))
        e = e.select("country", "iso_code", "year", *[F.col(c).cast("double").alias(c) for c in ("population", "gdp", *ENERGY_MEASURES)])
        j = lookup(e, self.generation_secondary, ["iso_code", "year"])
        j = j.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_secondary")) for _, c in P.GENERATION_SOURCES})
        j = lookup(j.drop(*[f"{c}_secondary" for _, c in P.GENERATION_SOURCES]), self.wb, ["iso_code", "year"])
        j = j.withColumns({"population": F.coalesce("population_wb", "population"), "gdp": F.coalesce("gdp_wb", "gdp")})
        j = lookup(self._bands(j.drop("population_wb", "gdp_wb")), self.continent_map, ["iso_code"])
        return self._cut(j.select("country", "iso_code", "continent", "continent_code", "year", "half_decade", "pandemic_period",
                                  "population", "gdp", *ENERGY_MEASURES), "energy_clean")
