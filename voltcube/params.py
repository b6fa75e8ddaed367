"""Parameters of the pipeline and of the role data.

Two groups: fixed values that must equal the source project's for the same
results (word lists, labels, cut-offs), and the parameters that adapt them to
the role tables derived from the TPC-H-shaped test data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source project's; kept in their natural order)
# ---------------------------------------------------------------------------

# Phrases removed from a lower-cased country name, applied one after another
# in this order ("republic of" before "republic"), then the ends are trimmed.
CLEAN_NAME_PHRASES = (
    "republic of", "republic", "kingdom of", "democratic",
    "people's", "cooperative", "federation", "state of",
    "principality of", "commonwealth of the", "commonwealth of",
)

# Name alias rule: a name containing the first text resolves to the candidate
# whose name contains the second.
NAME_ALIASES = (("korea", "south korea"),)


# Aggregate regions dropped from the long EV table.
AGGREGATE_REGIONS = ("World", "Europe", "EU27", "Rest of the world")

# Parameters dropped from the long EV table.
UNWANTED_PARAMETERS = ("Oil displacement Mbd", "Oil displacement, million lge")

# The parameter that holds charging points, and its two powertrain labels.
CHARGING_PARAMETER = "EV charging points"
FAST_LABEL = "Publicly available fast"
SLOW_LABEL = "Publicly available slow"

# Market parameters pivoted to columns (normalised: lower, blanks to "_").
MARKET_PARAMETERS = ("EV sales", "EV stock", "EV sales share", "EV stock share", "Electricity demand")

# Row filters of the long EV table.
HISTORICAL_CATEGORY = "Historical"
COUNTRY_AREA_TYPE = "Country or economy"

# Secondary generation source labels and the columns they patch.
GENERATION_SOURCES = (
    ("Total generation", "electricity_generation"),
    ("Demand", "electricity_demand"),
    ("Fossil", "fossil_generation"),
    ("Coal", "coal_generation"),
    ("Gas", "gas_generation"),
    ("Renewables", "renewable_generation"),
    ("Clean", "low_carbon_generation"),
    ("Wind", "wind_generation"),
    ("Hydro", "hydro_generation"),
    ("Nuclear", "nuclear_generation"),
    ("Solar", "solar_generation"),
    ("Net imports", "net_imports"),
)

# World Bank series codes.
SERIES_POPULATION = "SP.POP.TOTL"
SERIES_GDP = "NY.GDP.MKTP.CD"

# Year bands of the source project: (inclusive upper bound, label) then the
# label for everything above the last bound.
HALF_DECADE_BANDS = ((2014, "2010-2014"), (2019, "2015-2019")), "2020-2023"
PANDEMIC_BANDS = ((2019, "Pre-Pandemic"), (2021, "Pandemic")), "Post-Pandemic"

# GDP classes of the source project: lower bounds, inclusive.
GDP_HIGH = 1_000_000_000_000
GDP_MEDIUM = 100_000_000_000
GDP_LABELS = ("High GDP", "Medium GDP", "Low GDP")

# Study window of the source project.
STUDY_YEARS = (2010, 2023)


# ---------------------------------------------------------------------------
# Role-data parameters (FIXTURES.md section 4)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class RoleParams:
    """Parameters mapping the test tables onto the warehouse shapes."""

    base_year: int = 1994                  # key_y = year - base_year
    null_continent_nation: int = 24
    null_gdp_nation: int = 7
    zero_generation_nation: int = 5
    no_secondary_nation: int = 9
    duplicate_nation: int = 2
    gap_mod: int = 4                       # nations with n % gap_mod == gap_rem
    gap_rem: int = 1                       # lack infrastructure in gap_year
    gap_year: int = 1998
    projection_key_y: int = 7
    projection_category: str = "Projection-STEPS"
    stock_share_skip_mod: int = 3          # no 'EV stock share' where key_c % 3 == 0
    renewable_null_mod: int = 6            # energy_primary NULL renewable where (c + y) % 6 == 0
    fossil_null_mod: int = 5               # energy_primary NULL fossil where (c + y) % 5 == 0
    region_iso: str = "N00"
    missing_nation: int = 22               # not in the EV table; two spellings in the CO2 table
    energy_only_nation: int = 23           # in the energy table alone: its rows find no dimension row
    macro_duplicate_nation: int = 3        # two rows of each series in the wide table
    macro_years: tuple = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
    timing_null_mod: int = 97
    # Role year bands (same shape as the source bands, shifted to role years).
    half_decade_bands: tuple = field(default=(((1996, "1995-1996"), (1998, "1997-1998")), "1999-2001"))
    pandemic_bands: tuple = field(default=(((1997, "Pre-Pandemic"), (1999, "Pandemic")), "Post-Pandemic"))
    # The historical window of the role data (the projection year lies outside).
    study_years: tuple = (1995, 2000)

    # GDP class cut-offs of the role data (inclusive lower bounds of High and Medium).
    gdp_high: float = 25_000_000.0
    gdp_medium: float = 18_000_000.0


ROLE = RoleParams()

# Parameters of the name match: shared share of character 3-grams. Not the
# source project's value, whose ratio works on whole pairs of strings.
FUZZY_CUTOFF = 0.5

# Changes whenever the code gives stored tables other contents.
CODE_VERSION = "3"
