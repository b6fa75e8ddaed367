"""Warehouse schemas: Spark types of the star schema and measure additivity.

Additivity (a property of each measure, kept in the StructField metadata):

* ``flow``  - additive over every dimension (sales, demand, emissions);
* ``level`` - additive over countries, not over time (stock, chargers);
* ``unit``  - a ratio, never summed (shares, per-capita values).
"""

from __future__ import annotations

from pyspark.sql import types as T

FLOW, LEVEL, UNIT = "flow", "level", "unit"


def measure(name: str, dtype: T.DataType, additivity: str) -> T.StructField:
    return T.StructField(name, dtype, True, metadata={"additivity": additivity})


def key(name: str, dtype: T.DataType = T.IntegerType()) -> T.StructField:
    return T.StructField(name, dtype, False)


COUNTRY_DIM = T.StructType([
    key("key_c"), T.StructField("country", T.StringType(), False), T.StructField("iso_code", T.StringType(), False),
    T.StructField("continent", T.StringType(), True), T.StructField("continent_code", T.StringType(), True),
])
YEAR_DIM = T.StructType([
    key("key_y"), T.StructField("year", T.IntegerType(), False),
    T.StructField("half_decade", T.StringType(), False), T.StructField("pandemic_period", T.StringType(), False),
])
EV_MARKET = T.StructType([
    key("key_c"), key("key_y"), key("key_v"), key("key_p"),
    measure("ev_sales", T.LongType(), FLOW),
    measure("ev_sales_share", T.DecimalType(10, 6), UNIT),
    measure("ev_stock", T.DecimalType(15, 1), LEVEL),
    measure("ev_stock_share", T.DecimalType(10, 6), UNIT),
    measure("ev_electricity_demand", T.DecimalType(10, 2), FLOW),
])
EV_INFRASTRUCTURE = T.StructType([
    key("key_c"), key("key_y"),
    measure("ev_charging_points", T.LongType(), LEVEL),
    measure("fast_charging_points", T.LongType(), LEVEL),
    measure("slow_charging_points", T.LongType(), LEVEL),
    measure("charging_points_per_ev", T.DecimalType(10, 4), UNIT),
])
_D4, _D2 = T.DecimalType(18, 4), T.DecimalType(18, 2)
COUNTRY_ENERGY = T.StructType([
    key("key_c"), key("key_y"),
    *[measure(c, _D4, FLOW) for c in (
        "energy_consumption", "electricity_generation", "electricity_demand", "fossil_generation", "coal_generation",
        "oil_generation", "gas_generation", "renewable_generation", "low_carbon_generation", "wind_generation",
        "hydro_generation", "nuclear_generation", "other_generation", "solar_generation", "net_imports")],
])
COUNTRY_MACRO = T.StructType([
    key("key_c"), key("key_y"),
    measure("population", T.LongType(), LEVEL),
    measure("gdp", _D2, LEVEL),
    measure("co2_emissions", _D4, FLOW),
    measure("co2_per_capita", _D4, UNIT),
    measure("co2_per_gdp", _D4, UNIT),
    measure("oil_co2", _D4, FLOW),
    measure("oil_co2_per_capita", _D4, UNIT),
    measure("coal_co2", _D4, FLOW),
    measure("coal_co2_per_capita", _D4, UNIT),
    measure("co2_per_unit_energy", _D4, UNIT),
])
VEHICLE_TYPE_DIM = T.StructType([key("key_v"), T.StructField("vehicle_type", T.StringType(), False)])
POWERTRAIN_DIM = T.StructType([key("key_p"), T.StructField("powertrain", T.StringType(), False)])

# The warehouse: schema, primary key, unique columns and foreign keys of each table.
TABLES = {
    "country_dim": (COUNTRY_DIM, ("key_c",), ("iso_code",), {}),
    "year_dim": (YEAR_DIM, ("key_y",), ("year",), {}),
    "vehicle_type_dim": (VEHICLE_TYPE_DIM, ("key_v",), ("vehicle_type",), {}),
    "powertrain_dim": (POWERTRAIN_DIM, ("key_p",), ("powertrain",), {}),
    "ev_market": (EV_MARKET, ("key_c", "key_y", "key_v", "key_p"), (),
                  {"key_c": "country_dim", "key_y": "year_dim", "key_v": "vehicle_type_dim", "key_p": "powertrain_dim"}),
    "ev_infrastructure": (EV_INFRASTRUCTURE, ("key_c", "key_y"), (), {"key_c": "country_dim", "key_y": "year_dim"}),
    "country_energy": (COUNTRY_ENERGY, ("key_c", "key_y"), (), {"key_c": "country_dim", "key_y": "year_dim"}),
    "country_macro": (COUNTRY_MACRO, ("key_c", "key_y"), (), {"key_c": "country_dim", "key_y": "year_dim"}),
}

# Maximum lengths of the text columns (VARCHAR(n) / CHAR(n) of the DDL).
TEXT_LENGTHS = {"country": 50, "iso_code": 3, "continent": 50, "continent_code": 2, "half_decade": 15, "pandemic_period": 20,
                "vehicle_type": 50, "powertrain": 50}


def additivity_of(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.metadata["additivity"] for f in schema.fields if "additivity" in f.metadata}


def decimal_bound(dtype: T.DecimalType) -> float:
    """Largest magnitude a DECIMAL(p, s) holds."""
    return 10 ** (dtype.precision - dtype.scale) - 10 ** (-dtype.scale)
