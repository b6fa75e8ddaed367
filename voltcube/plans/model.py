"""Warehouse model from the clean tables: dimensions with surrogate keys, the
four facts with resolved keys, the skip report, and loads of them into a store:
whole, or on top of an earlier load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube import schema as S
from voltcube.operators.joins import first_per_key
from voltcube.plans.cleaning import Cleaning
from voltcube.plans.roles import ENERGY_MEASURES, Roles
from voltcube.plans.stored import at_once, store_for
from voltcube.plans.warehouse import YEAR_KEY, Warehouse, declared, key_checks, surrogate_dim
from voltcube.session import materialize
from voltcube.sources.store import Load, VersionedStore, extend_keys, merge_upsert


def first_of_sources(ev: DataFrame, co2: DataFrame, key: str, cols) -> DataFrame:
    """Rows of the EV table, then the CO2 table; per key the first row wins. Both
    tables are in the order (country, year), which breaks ties within a source."""
    at = lambda src: F.struct(F.lit(src).alias("src"), F.col("country").alias("c"), F.col("year").alias("y"))
    take = [c for c in dict.fromkeys([key, *cols])]
    u = ev.select(*take, at(0).alias("_at")).unionByName(co2.select(*take, at(1).alias("_at")))
    return first_per_key(u.where(F.col(key).isNotNull()), [key], "_at", [c for c in cols if c != key])


class Model:
    #: fact name -> (clean table, measures of the fact {column: clean column})
    FACTS = {
        "ev_market": ("market_clean", {c: c for c in ("ev_sales", "ev_sales_share", "ev_stock", "ev_stock_share", "ev_electricity_demand")}),
        "ev_infrastructure": ("infra_clean", {c: c for c in ("ev_charging_points", "fast_charging_points", "slow_charging_points", "charging_points_per_ev")}),
        "country_energy": ("energy_clean", {c: c for c in ENERGY_MEASURES}),
        "country_macro": ("co2_clean", {c: c for c in ("population", "gdp", "co2_emissions", "co2_per_capita", "co2_per_gdp", "oil_co2", "oil_co2_per_capita",
                                                        "coal_co2", "coal_co2_per_capita", "co2_per_unit_energy")}),
    }

    #: Dimension -> (natural key, surrogate key).
    DIMS = {"country_dim": ("iso_code", "key_c"), "year_dim": ("year", "key_y"), "vehicle_type_dim": ("vehicle_type", "key_v"), "powertrain_dim": ("powertrain", "key_p")}

    def __init__(self, cleaning: Cleaning, known: Mapping[str, DataFrame] | None = None):
        """``known``: dimensions of an earlier load; their rows keep their keys and attributes."""
        self.c = cleaning
        self.known = known or {}

    @cached_property
    def country_dim(self) -> DataFrame:
        """Countries of the EV table, then the CO2 table; per ISO code the first row wins."""
        d = first_of_sources(self.c.market_clean, self.c.co2_clean, "iso_code", ["country", "continent", "continent_code"])
        return extend_keys(self.known.get("country_dim"), d.select("iso_code", "country", "continent", "continent_code"), "iso_code", "key_c")

    @cached_property
    def year_dim(self) -> DataFrame:
        d = first_of_sources(self.c.market_clean, self.c.co2_clean, "year", ["half_decade", "pandemic_period"])
        return extend_keys(self.known.get("year_dim"), d, "year", "key_y")

    @cached_property
    def vehicle_type_dim(self) -> DataFrame:
        return surrogate_dim(self.c.market_clean, "vehicle_type", "key_v", self.known.get("vehicle_type_dim"))

    @cached_property
    def powertrain_dim(self) -> DataFrame:
        return surrogate_dim(self.c.market_clean, "powertrain", "key_p", self.known.get("powertrain_dim"))

    def _keyed(self, fact: str) -> DataFrame:
        """The fact's clean rows with their keys, NULL where no dimension row fits."""
        clean, _ = self.FACTS[fact]
        j = getattr(self.c, clean).join(self.country_dim.select("key_c", "iso_code"), "iso_code", "left").join(self.year_dim.select("key_y", "year"), "year", "left")
        if "key_v" in S.TABLES[fact][1]:
            j = j.join(self.vehicle_type_dim, "vehicle_type", "left").join(self.powertrain_dim, "powertrain", "left")
        return j

    def _found(self, fact: str):
        ok = F.lit(True)
        for k in S.TABLES[fact][1]:
            ok = ok & F.col(k).isNotNull()
        return ok

    def fact_rows(self, name: str) -> DataFrame:
        """Rows with all their keys, whole numbers rounded; rows with an unknown key are skipped. Of several rows of
        a key the last in table order replaces the others (insert or update, statement by statement)."""
        schema, pk, _, _ = S.TABLES[name]
        _, measures = self.FACTS[name]
        rows = self._keyed(name).where(self._found(name))
        values = [(F.round(F.col(c)) if f.dataType.typeName() == "long" else F.col(c)).alias(f.name) for f in schema.fields if (c := measures.get(f.name))]
        rows = rows.select(*pk, *values, F.struct("country", "year").alias("_at"))
        return first_per_key(rows, pk, "_at", [c for c in schema.names if c not in pk], last=True)

    def fact(self, name: str) -> DataFrame:
        """``fact_rows`` in the fact's types."""
        return self.fact_rows(name).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TABLES[name][0].fields])

    def skips(self) -> DataFrame:
        """Rows loaded and skipped per fact (a key without a dimension row)."""
        parts = []
        for name in self.FACTS:
            ok = self._found(name)
            parts.append(self._keyed(name).agg(F.count_if(ok).cast("bigint").alias("loaded"), F.count_if(~ok).cast("bigint").alias("skipped"))
                             .select(F.lit(name).alias("fact_name"), "loaded", "skipped"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def write_model(load: Load, model: Model) -> None:
    """Write what a load on top of ``load.base`` changes: dimensions with unseen labels, and of each fact the years
    that the model has rows of, merged with the rows they had. Without a base all tables are written."""
    spark = load.store.spark
    first = load.base is None

    def dim(name: str) -> None:
        natural, _ = model.DIMS[name]
        made = getattr(model, name)
        if first or not made.join(model.known[name].select(natural), natural, "left_anti").isEmpty():
            model.__dict__[name] = load.write(name, declared(name, made))
        else:
            model.__dict__[name] = model.known[name]

    def fact(name: str) -> None:
        rows = model.fact_rows(name)
        if first:
            load.write(name, declared(name, rows))
            return
        # Written once: it is asked for the years it touches, then merged.
        rows = materialize(spark, rows, f"load-{name}")
        years = sorted(r[0] for r in rows.select(YEAR_KEY).distinct().collect())
        if years:
            known = load.store.read(name, load.base).where(F.col(YEAR_KEY).isin(years))      # reads these years' folders alone
            load.write(name, declared(name, merge_upsert(known, rows, S.TABLES[name][1])), replaces=years)

    at_once([partial(dim, n) for n in model.DIMS])
    at_once([partial(fact, n) for n in model.FACTS])


def load_clean(store: VersionedStore, cleaning: Cleaning, base: int | None = None) -> int:
    """One load of clean tables (all of them, or what is new or changed) into the store: a new version. On top of
    ``base`` dimension rows keep their keys, facts are inserted or replaced by key, and what the load does not touch
    stays in the files it is in. Loads in sequence give the rows of one load of everything."""
    with Load(store, base) as load:
        write_model(load, Model(cleaning, None if base is None else store.read_all(tuple(Model.DIMS), base)))
        return load.commit(key_checks(load))


def load_pipeline(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse made from the cleaned tables: raw -> clean -> dimensions ->
    keyed facts -> checks -> published, once per input version."""
    roles = Roles(spark, sf_dir)
    store = store_for(roles, "pipeline")
    version = store.current_version()
    if version is None:
        version = load_clean(store, Cleaning.load(spark, sf_dir, roles))
    return Warehouse(**store.read_all(Warehouse.TABLES, version), params=roles.p)
