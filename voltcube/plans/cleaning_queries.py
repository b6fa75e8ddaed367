"""Query keys of the cleaning flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube import params as P
from voltcube.functions.scalar import band, clean_name as clean_name_expr, ieee_divide, nan_to_null, to_decimal, to_int_rounded
from voltcube.operators.reshape import pivot_found
from voltcube.plans.cleaning import RAW_EV_ORDER, Cleaning, step_name
from voltcube.plans.olap import r6
from voltcube.plans.roles import ENERGY_MEASURES, Roles
from voltcube.plans.warehouse import Warehouse
from voltcube.session import scratch_path
from voltcube.sources.files import read_csv, scan_csv as guarded_scan, write_csv


def _cleaning(spark: SparkSession, sf_dir: str) -> Cleaning:
    """The stored clean tables (one version per input, shared by all keys)."""
    return Cleaning.load(spark, sf_dir)


def _y(c="year"):
    return F.col(c).cast("bigint").alias(c)


def clean_long(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).clean_long
    return c.select("region", "country", "iso_code", _y(), "mode", "powertrain", "parameter", r6("value").alias("value"))


def split_parameter(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir)
    cols = ["country", "iso_code", _y(), "mode", "powertrain", "parameter", r6("value").alias("value")]
    return (c.infra_long.select(F.lit("infrastructure").alias("part"), *cols)
            .unionByName(c.vehicle_long.select(F.lit("vehicle").alias("part"), *cols)))


def clean_name(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir)
    names = c.ev_filtered.select(F.col("region").alias("name")).distinct()
    return names.select("name", clean_name_expr("name").alias("cleaned"))


def resolve_exact(spark, sf_dir) -> DataFrame:
    r = _cleaning(spark, sf_dir).exact_names
    return r.select("name", "iso_code", "country", step_name().alias("method"))


def resolve_fuzzy(spark, sf_dir) -> DataFrame:
    r = _cleaning(spark, sf_dir).resolved_names
    return r.select("name", "iso_code", "country", step_name().alias("method"))


def pivot_first(spark, sf_dir) -> DataFrame:
    m = _cleaning(spark, sf_dir).market_clean
    nums = ["ev_sales", "ev_stock", "ev_sales_share", "ev_stock_share", "ev_electricity_demand", "population", "gdp"]
    return m.select("country", "iso_code", "continent", "continent_code", _y(), "half_decade", "pandemic_period",
                    "vehicle_type", "powertrain", *[r6(c).alias(c) for c in nums])


def pivot_sum(spark, sf_dir) -> DataFrame:
    i = _cleaning(spark, sf_dir).infra_clean
    nums = ["ev_charging_points", "fast_charging_points", "slow_charging_points"]
    return i.select("country", "iso_code", "continent", "continent_code", _y(), "half_decade", "pandemic_period",
                    *[r6(c).alias(c) for c in nums])


def unpivot_years(spark, sf_dir) -> DataFrame:
    w = _cleaning(spark, sf_dir).wb_long
    return w.select("iso_code", "series_code", F.col("seq").cast("bigint").alias("seq"), _y(), r6("value").alias("value"))


def gap_patch(spark, sf_dir) -> DataFrame:
    e = _cleaning(spark, sf_dir).energy_clean
    return e.select("iso_code", _y(), *[r6(c).alias(c) for c in ("population", "gdp", *ENERGY_MEASURES)])


CO2_MEASURES = ("population", "gdp", "co2_emissions", "co2_per_capita", "co2_per_gdp", "oil_co2", "oil_co2_per_capita", "coal_co2",
                "coal_co2_per_capita", "co2_per_unit_energy", "energy_consumption")


def clean_macro(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).co2_selected
    return c.select("country", "iso_code", _y(), *[r6(x).alias(x) for x in CO2_MEASURES])


def source_override(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).co2_override
    return c.select("country", "iso_code", _y(), r6("population").alias("population"), r6("gdp").alias("gdp"))


def derived_ratios(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).co2_clean
    return c.select("country", "iso_code", _y(), *[r6(x).alias(x) for x in ("co2_per_capita", "co2_per_gdp", "oil_co2_per_capita", "coal_co2_per_capita")])


def lookup_attr(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).co2_clean
    return c.select("country", "iso_code", _y(), "continent", "continent_code", "half_decade", "pandemic_period")


def charger_ratio(spark, sf_dir) -> DataFrame:
    c = _cleaning(spark, sf_dir).infra_clean
    return c.select("iso_code", _y(), r6("ev_charging_points").alias("ev_charging_points"),
                    r6("charging_points_per_ev").alias("charging_points_per_ev"))


def map_override(spark, sf_dir) -> DataFrame:
    return _cleaning(spark, sf_dir).name_map.select("name", "iso_code")


def null_hygiene(spark, sf_dir) -> DataFrame:
    e = Roles(spark, sf_dir).country_energy
    return e.select(F.col("key_c").cast("bigint").alias("key_c"), F.col("key_y").cast("bigint").alias("key_y"),
                    r6(nan_to_null(ieee_divide("renewable_generation", "electricity_generation"))).alias("renewable_share"),
                    r6(nan_to_null(ieee_divide("fossil_generation", "electricity_generation"))).alias("fossil_share"))


# Warehouse type of each EV parameter (DDL of the market fact).
PARAMETER_TYPES = {
    "EV sales": ("bigint",),
    "EV stock": ("decimal", 15, 1),
    "EV stock share": ("decimal", 10, 6),
    "Electricity demand": ("decimal", 10, 2),
    "Oil displacement Mbd": ("bigint",),
}


def quantize_types(spark, sf_dir) -> DataFrame:
    """Each value cast to its warehouse type: integers round half away from
    zero (a plain cast would truncate), decimals round HALF_UP to their scale."""
    raw = _cleaning(spark, sf_dir).ev_filtered
    expr = None
    for param, t in PARAMETER_TYPES.items():
        q = to_int_rounded("value", "bigint") if t[0] == "bigint" else to_decimal("value", t[1], t[2])
        cond = F.col("parameter") == param
        expr = F.when(cond, q.cast("double")) if expr is None else expr.when(cond, q.cast("double"))
    return raw.select("region", _y(), "mode", "powertrain", "parameter", r6(expr).alias("value"))


def time_bands(spark, sf_dir) -> DataFrame:
    roles = Roles(spark, sf_dir)
    y = roles.year_dim.select("year")
    p = roles.p
    return y.select(_y(),
                    band("year", p.half_decade_bands).alias("half_decade"),
                    band("year", p.pandemic_bands).alias("pandemic_period"),
                    band("year", P.HALF_DECADE_BANDS).alias("half_decade_source"),
                    band("year", P.PANDEMIC_BANDS).alias("pandemic_period_source"))


def star_join(spark, sf_dir) -> DataFrame:
    w = Warehouse.load(spark, sf_dir)
    from voltcube.operators.joins import star_join as join_dims
    j = join_dims(w.ev_market, [(w.country_dim.select("key_c", "country", "continent"), ["key_c"], True),
                                (w.year_dim.select("key_y", "year", "pandemic_period"), ["key_y"], True),
                                (w.vehicle_type_dim, ["key_v"], True),
                                (w.powertrain_dim, ["key_p"], True)])
    return j.select("country", "continent", _y(), "pandemic_period", "vehicle_type", "powertrain",
                    F.col("ev_sales").cast("bigint").alias("ev_sales"), r6("ev_stock").alias("ev_stock"))


def sort_nulls(spark, sf_dir) -> DataFrame:
    """Order by year, then renewable generation descending with NULLs first
    (PostgreSQL's DESC default), then country ascending with NULLs last. The
    position within the year proves the order; it is numbered per year, so no
    single task sees the whole table."""
    roles = Roles(spark, sf_dir)
    j = roles.energy_primary
    w = Window.partitionBy("year").orderBy(F.col("renewable_generation").desc_nulls_first(),
                                           F.col("country").asc_nulls_last())
    return j.select(_y(), "country", r6("renewable_generation").alias("renewable_generation"),
                    F.row_number().over(w).cast("bigint").alias("pos"))


CLEAN_TABLES = ("market_clean", "infra_clean", "co2_clean", "energy_clean")


def clean_tables(spark, sf_dir) -> DataFrame:
    """The four clean tables written as CSV files with a header and read back with
    their schemas: rows, filled cells and the sum of the years of each."""
    c = _cleaning(spark, sf_dir)
    parts = []
    for name in CLEAN_TABLES:
        df = getattr(c, name)
        path = scratch_path(spark, f"csv-{name}")
        write_csv(df, path)
        back = read_csv(spark, path, df.schema)
        filled = sum((F.count(x) for x in back.columns), F.lit(0))
        parts.append(back.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), filled.cast("bigint").alias("filled"),
                              F.sum("year").cast("bigint").alias("year_sum")).select(F.lit(name).alias("table_name"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Raw sources as they come in CSV files: typed columns, the one whose values are spoilt in some rows (so that the
#: guard is seen at work), the spoilt value and rows, and the column whose sum is reported.
CSV_SOURCES = {
    "raw_ev": ("region string, category string, parameter string, mode string, powertrain string, year int, value double",
               "value", "n/a", "year = 1997 and parameter = 'EV stock'", "value"),
    "raw_co2": ("country string, year int, iso_code string, population double, gdp double, co2 double", "year", "Y2K", "iso_code = 'N04'", "co2"),
    "energy_primary": ("country string, iso_code string, year int, population double, gdp double, energy_consumption decimal(18,4), electricity_generation decimal(18,4)",
                       "gdp", "unknown", "year = 1996", "energy_consumption"),
    "raw_generation": ("iso_code string, year int, area_type string, source string, generation double, seq int", "generation", "--", "source = 'Coal'", "generation"),
    "raw_macro": ("iso_code string, series_code string, seq int, `1995 [YR1995]` string, `1996 [YR1996]` string", "seq", "first", "iso_code = 'N06'", "seq"),
}

#: Names of this country get a second line with quotes and a comma.
TWO_LINES = "N02"


def scan_csv_sources(spark, sf_dir) -> DataFrame:
    """The five raw sources written as CSV files, columns in another order and some values spoilt, and scanned with
    the guard: rows, rejected records, filled cells, the sum of a column and the names of two lines."""
    roles, parts = Roles(spark, sf_dir), []
    for name, (schema, spoilt, value, where, total) in CSV_SOURCES.items():
        declared = T.StructType.fromDDL(schema)
        df = getattr(roles, name)
        text = {c: F.col(f"`{c}`").cast("string") for c in df.columns}
        if "country" in text:
            text["country"] = F.when(F.col("iso_code") == TWO_LINES, F.concat("country", F.lit('\n"so called", here'))).otherwise(text["country"])
        text[spoilt] = F.when(F.expr(where), F.lit(value)).otherwise(text[spoilt])
        path = scratch_path(spark, f"raw-{name}")
        write_csv(df.select(*[text[c].alias(c) for c in reversed(df.columns)]), path)
        got = guarded_scan(spark, path, declared, name, multi_line=True)
        named = F.col("country") if "country" in declared.names else F.col("region") if "region" in declared.names else F.lit("")
        filled = sum((F.count(f"`{c}`") for c in declared.names), F.lit(0))
        rejects = got.rejects.agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        parts.append(got.rows.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), filled.cast("bigint").alias("filled"),
                                  F.sum(F.col(total).cast("decimal(20,6)")).cast("double").alias("total"),
                                  F.count_if(named.contains("\n")).cast("bigint").alias("two_lines"))
                     .select(F.lit(name).alias("source"), "*", rejects.scalar().alias("rejects")))
    return reduce(DataFrame.unionByName, parts)


def pivot_labels(spark, sf_dir) -> DataFrame:
    """The market pivoted by the labels its rows have, a new one among them that no list names."""
    long = _cleaning(spark, sf_dir).vehicle_long
    load = long.where(F.col("parameter") == "Electricity demand").withColumn("parameter", F.lit(" Charging Load ")).withColumn("value", F.col("value") * 2)
    index = ["country", "iso_code", "year", "mode", "powertrain"]
    wide = pivot_found(long.unionByName(load), index, "parameter", "value", F.struct(*RAW_EV_ORDER))
    return wide.select("country", "iso_code", _y(), F.col("mode").alias("vehicle_type"), "powertrain", *[r6(c).alias(c) for c in wide.columns if c not in index])


CLEANING = {
    "clean_long": clean_long, "split_parameter": split_parameter, "clean_name": clean_name,
    "resolve_exact": resolve_exact, "resolve_fuzzy": resolve_fuzzy, "pivot_first": pivot_first,
    "pivot_sum": pivot_sum, "unpivot_years": unpivot_years, "gap_patch": gap_patch, "clean_macro": clean_macro,
    "source_override": source_override, "derived_ratios": derived_ratios, "lookup_attr": lookup_attr,
    "charger_ratio": charger_ratio, "map_override": map_override, "null_hygiene": null_hygiene,
    "quantize_types": quantize_types, "time_bands": time_bands, "star_join": star_join, "sort_nulls": sort_nulls, "clean_tables": clean_tables,
    "scan_csv_sources": scan_csv_sources, "pivot_labels": pivot_labels,
}
