"""DuckDB oracle statements for the cleaning keys.

The resolution keys compute every step from the strings; the flows behind them
use its known answer (``dirty_name`` joined to ``country_dim``). "First row"
rules use the role tables' ``seq``.
"""

from __future__ import annotations

from voltcube.params import CLEAN_NAME_PHRASES, FUZZY_CUTOFF, GENERATION_SOURCES
from voltcube.plans.roles import ENERGY_MEASURES

HALF = ("case when year <= 1996 then '1995-1996' when year <= 1998 then '1997-1998' "
        "else '1999-2001' end")
PANDEMIC = ("case when year <= 1997 then 'Pre-Pandemic' when year <= 1999 then 'Pandemic' "
            "else 'Post-Pandemic' end")

CL = """cl as (
  select r.seq, r.region, c.country, c.iso_code, r.year, r.mode, r.powertrain, r.parameter, r.value
  from raw_ev r join dirty_name d on r.region = d.region join country_dim c on d.key_c = c.key_c
  where r.category = 'Historical' and r.year between 1995 and 2000
    and r.region not in ('World', 'Europe', 'EU27', 'Rest of the world')
    and r.parameter not in ('Oil displacement Mbd', 'Oil displacement, million lge'))"""

EVF = """evf as (
  select * from raw_ev
  where category = 'Historical' and year between 1995 and 2000
    and region not in ('World', 'Europe', 'EU27', 'Rest of the world'))"""

YEARS = range(1995, 2002)
WB = "wb_long as (\n  " + "\n  union all\n  ".join(
    f"""select iso_code, series_code, seq, {y} as year, try_cast("{y} [YR{y}]" as double) as value from raw_macro where iso_code is not null""" for y in YEARS) + """),
wb as (
  select iso_code, year,
         arg_min(value, seq) filter (where series_code = 'SP.POP.TOTL' and value is not null) as population_wb,
         arg_min(value, seq) filter (where series_code = 'NY.GDP.MKTP.CD' and value is not null) as gdp_wb
  from wb_long group by iso_code, year
  having count(case when series_code in ('SP.POP.TOTL', 'NY.GDP.MKTP.CD') then value end) > 0)"""

PF = """pf as (
  select country, iso_code, year, mode as vehicle_type, powertrain,
         arg_min(value, seq) filter (where parameter = 'EV sales' and value is not null) as ev_sales,
         arg_min(value, seq) filter (where parameter = 'EV stock' and value is not null) as ev_stock,
         arg_min(value, seq) filter (where parameter = 'EV sales share' and value is not null) as ev_sales_share,
         arg_min(value, seq) filter (where parameter = 'EV stock share' and value is not null) as ev_stock_share,
         arg_min(value, seq) filter (where parameter = 'Electricity demand' and value is not null) as ev_electricity_demand
  from cl where parameter is distinct from 'EV charging points'
  group by country, iso_code, year, mode, powertrain)"""

PS = """ps as (
  select country, iso_code, year,
         coalesce(sum(case when powertrain = 'Publicly available fast' then value end), 0) as fast_charging_points,
         coalesce(sum(case when powertrain = 'Publicly available slow' then value end), 0) as slow_charging_points
  from cl where parameter = 'EV charging points'
  group by country, iso_code, year)"""

CO2 = """co2s as (
  select country, iso_code, year, population, gdp, co2 as co2_emissions, co2_per_capita, co2_per_gdp, oil_co2, oil_co2_per_capita,
         coal_co2, coal_co2_per_capita, co2_per_unit_energy, primary_energy_consumption as energy_consumption
  from raw_co2 where iso_code is not null and year between 1995 and 2000),
co2o as (
  select s.* replace (coalesce(wb.population_wb, s.population) as population, coalesce(wb.gdp_wb, s.gdp) as gdp)
  from co2s s left join wb on s.iso_code = wb.iso_code and s.year = wb.year),
co2c as (
  select * replace (case when population = 0 then null else co2_emissions * 1e6 / population end as co2_per_capita,
                    case when gdp = 0 then null else co2_emissions * 1e9 / gdp end as co2_per_gdp,
                    case when population = 0 then null else oil_co2 * 1e6 / population end as oil_co2_per_capita,
                    case when population = 0 then null else coal_co2 * 1e6 / population end as coal_co2_per_capita)
  from co2o)"""

STOCK = """stock as (select iso_code, year, sum(coalesce(ev_stock, 0)) as total_stock from pf group by iso_code, year),
infra as (
  select ps.*, fast_charging_points + slow_charging_points as ev_charging_points,
         case when s.total_stock is null or s.total_stock = 0 then 0
              else (fast_charging_points + slow_charging_points) / s.total_stock end as charging_points_per_ev
  from ps left join stock s on ps.iso_code = s.iso_code and ps.year = s.year)"""

_FIRST = ",\n         ".join(f"arg_min(generation, seq) filter (where source = '{label}' and generation is not null) as {c}" for label, c in GENERATION_SOURCES)
_PATCHED = [c for _, c in GENERATION_SOURCES]
_ENERGY = ",\n         ".join(f"coalesce(cast(e.{c} as double), s.{c}) as {c}" if c in _PATCHED else f"cast(e.{c} as double) as {c}" for c in ENERGY_MEASURES)
ENERGY = f"""sec as (
  select iso_code, year, {_FIRST}
  from raw_generation where area_type = 'Country or economy' group by iso_code, year),
energy as (
  select e.country, e.iso_code, e.year, coalesce(wb.population_wb, e.population) as population, coalesce(wb.gdp_wb, e.gdp) as gdp,
         {_ENERGY}
  from energy_primary e left join sec s on e.iso_code = s.iso_code and e.year = s.year
  left join wb on e.iso_code = wb.iso_code and e.year = wb.year
  where e.year between 1995 and 2000)"""

CO2_MEASURES = ("population", "gdp", "co2_emissions", "co2_per_capita", "co2_per_gdp", "oil_co2", "oil_co2_per_capita", "coal_co2",
                "coal_co2_per_capita", "co2_per_unit_energy", "energy_consumption")


def rounded(cols) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols)


def clean(x: str) -> str:
    x = f"lower({x})"
    for phrase in CLEAN_NAME_PHRASES:
        x = f"replace({x}, '{phrase.replace(chr(39), chr(39) * 2)}', '')"
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"


def grams(x: str) -> str:
    return f"list_distinct([substr('  ' || {x} || ' ', i, 3) for i in range(1, length({x}) + 2)])"


#: Steps 1 to 6 of the name resolution for every name: the lowest step that matches, then its rule.
RESOLVED = f"""cands as (
  select cand, iso, row_number() over (order by src, cand) as nr
  from (select cand, max_by(iso, src) as iso, min(src) as src
        from (select country as cand, iso_code as iso, 0 as src from raw_co2 union all select country, iso_code, 1 from energy_primary) u
        where iso is not null group by cand) n),
names as (select distinct region as name from evf),
exact as (
  select name, iso, cand, step, nr from names, cands, (select unnest([1, 2, 3, 4]) as step) t
  where (step = 1 and lower(name) = lower(cand)) or (step = 2 and upper(name) = iso) or (step = 3 and {clean('name')} = {clean('cand')})
     or (step = 4 and lower(name) like '%korea%' and lower(cand) like '%south korea%')
  qualify row_number() over (partition by name order by step, nr) = 1),
keys as (
  select 5 as step, {clean('cand')} as k, cand, iso from cands qualify row_number() over (partition by k order by nr desc) = 1
  union all
  select 6, lower(cand) as k, cand, iso from cands qualify row_number() over (partition by k order by nr) = 1),
scored as (
  select name, iso, cand, step, k, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) as score
  from (select name, iso, cand, step, k, {grams('k')} as a, {grams("case step when 5 then " + clean('name') + " else lower(name) end")} as b
        from names, keys where name not in (select name from exact)) x),
fuzzy as (
  select * from scored where score >= {FUZZY_CUTOFF} qualify row_number() over (partition by name order by step, score desc, k desc) = 1),
resolved as (
  select name, iso as iso_code, cand as country, ['exact', 'iso', 'cleaned', 'alias'][step] as method from exact
  union all
  select name, iso, cand, case step when 5 then 'fuzzy_cleaned' else 'fuzzy_raw' end from fuzzy)"""

def _csv_sources() -> str:
    """Counts of each raw source without its spoilt rows, whose number is the rejects."""
    cells = {
        "raw_ev": (["region", "category", "parameter", "mode", "powertrain", "year", "value"], "year = 1997 and parameter = 'EV stock'", "value", "contains(region, chr(10))"),
        "raw_co2": (["country", "year", "iso_code", "population", "gdp", "co2"], "iso_code = 'N04'", "co2", "iso_code = 'N02'"),
        "energy_primary": (["country", "iso_code", "year", "population", "gdp", "energy_consumption", "electricity_generation"], "year = 1996", "energy_consumption", "iso_code = 'N02'"),
        "raw_generation": (["iso_code", "year", "area_type", "source", "generation", "seq"], "source = 'Coal'", "generation", "false"),
        "raw_macro": (["iso_code", "series_code", "seq", '"1995 [YR1995]"', '"1996 [YR1996]"'], "iso_code = 'N06'", "seq", "false"),
    }
    out = []
    for name, (columns, bad, total, two) in cells.items():
        ok = f"filter (where not coalesce({bad}, false))"
        out.append(f"select '{name}' as source, cast(count(*) {ok} as bigint) as rows, cast({' + '.join(f'count({c}) {ok}' for c in columns)} as bigint) as filled, "
                   f"cast(sum(cast({total} as decimal(20,6))) {ok} as double) as total, cast(count(*) filter (where {two} and not coalesce({bad}, false)) as bigint) as two_lines, "
                   f"cast(count(*) filter (where {bad}) as bigint) as rejects from {name}")
    return "\nunion all\n".join(out)


CLEANING = {
    "scan_csv_sources": _csv_sources(),
    "pivot_labels": f"""with {CL}, {PF}
select country, iso_code, cast(year as bigint) as year, vehicle_type, powertrain, round(2 * ev_electricity_demand, 6) as charging_load,
       round(ev_electricity_demand, 6) as electricity_demand, round(ev_sales, 6) as ev_sales, round(ev_stock, 6) as ev_stock, round(ev_stock_share, 6) as ev_stock_share
from pf where coalesce(ev_sales, ev_stock, ev_stock_share, ev_electricity_demand) is not null""",
    "clean_long": f"""with {CL}
select region, country, iso_code, cast(year as bigint) as year, mode, powertrain, parameter, round(value, 6) as value from cl""",
    "split_parameter": f"""with {CL}
select case when parameter = 'EV charging points' then 'infrastructure' else 'vehicle' end as part,
       country, iso_code, cast(year as bigint) as year, mode, powertrain, parameter, round(value, 6) as value from cl""",
    "clean_name": f"""with {EVF}
select distinct region as name, {clean('region')} as cleaned from evf""",
    "resolve_exact": f"""with {EVF}, {RESOLVED}
select * from resolved where method not like 'fuzzy%'""",
    "resolve_fuzzy": f"""with {EVF}, {RESOLVED}
select * from resolved""",
    "pivot_first": f"""with {CL}, {WB}, {PF}
select pf.country, pf.iso_code, cm.continent, cm.continent_code, cast(pf.year as bigint) as year,
       {HALF.replace('year', 'pf.year')} as half_decade, {PANDEMIC.replace('year', 'pf.year')} as pandemic_period,
       pf.vehicle_type, pf.powertrain,
       round(coalesce(pf.ev_sales, 0), 6) as ev_sales, round(coalesce(pf.ev_stock, 0), 6) as ev_stock,
       round(coalesce(pf.ev_sales_share, 0), 6) as ev_sales_share, round(coalesce(pf.ev_stock_share, 0), 6) as ev_stock_share,
       round(coalesce(pf.ev_electricity_demand, 0), 6) as ev_electricity_demand,
       round(wb.population_wb, 6) as population, round(wb.gdp_wb, 6) as gdp
from pf
left join country_dim cm on pf.iso_code = cm.iso_code
left join wb on pf.iso_code = wb.iso_code and pf.year = wb.year
where coalesce(pf.ev_sales, pf.ev_stock, pf.ev_sales_share, pf.ev_stock_share, pf.ev_electricity_demand) is not null""",
    "pivot_sum": f"""with {CL}, {PS}
select ps.country, ps.iso_code, cm.continent, cm.continent_code, cast(ps.year as bigint) as year,
       {HALF.replace('year', 'ps.year')} as half_decade, {PANDEMIC.replace('year', 'ps.year')} as pandemic_period,
       round(fast_charging_points + slow_charging_points, 6) as ev_charging_points,
       round(fast_charging_points, 6) as fast_charging_points, round(slow_charging_points, 6) as slow_charging_points
from ps left join country_dim cm on ps.iso_code = cm.iso_code""",
    "unpivot_years": f"""with {WB}
select iso_code, series_code, cast(seq as bigint) as seq, cast(year as bigint) as year, round(value, 6) as value from wb_long""",
    "gap_patch": f"""with {WB}, {ENERGY}
select iso_code, cast(year as bigint) as year, {rounded(("population", "gdp", *ENERGY_MEASURES))} from energy""",
    "clean_macro": f"""with {WB}, {CO2}
select country, iso_code, cast(year as bigint) as year, {rounded(CO2_MEASURES)} from co2s""",
    "source_override": f"""with {WB}, {CO2}
select country, iso_code, cast(year as bigint) as year, round(population, 6) as population, round(gdp, 6) as gdp from co2o""",
    "derived_ratios": f"""with {WB}, {CO2}
select country, iso_code, cast(year as bigint) as year, {rounded(("co2_per_capita", "co2_per_gdp", "oil_co2_per_capita", "coal_co2_per_capita"))} from co2c""",
    "lookup_attr": f"""with {WB}, {CO2}
select o.country, o.iso_code, cast(o.year as bigint) as year, cm.continent, cm.continent_code,
       {HALF.replace('year', 'o.year')} as half_decade, {PANDEMIC.replace('year', 'o.year')} as pandemic_period
from co2o o left join country_dim cm on o.iso_code = cm.iso_code""",
    "charger_ratio": f"""with {CL}, {PF}, {PS}, {STOCK}
select iso_code, cast(year as bigint) as year, round(ev_charging_points, 6) as ev_charging_points,
       round(charging_points_per_ev, 6) as charging_points_per_ev from infra""",
    "map_override": """
select distinct country as name, iso_code from (select country, iso_code from raw_co2 union all select country, iso_code from energy_primary) u""",
    "null_hygiene": """
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y,
       case when electricity_generation = 0 then null
            else round(cast(renewable_generation as double) / cast(electricity_generation as double), 6) end as renewable_share,
       case when electricity_generation = 0 then null
            else round(cast(fossil_generation as double) / cast(electricity_generation as double), 6) end as fossil_share
from country_energy""",
    "quantize_types": f"""with {EVF}
select region, cast(year as bigint) as year, mode, powertrain, parameter,
       round(case parameter when 'EV sales' then cast(cast(round(value) as bigint) as double)
                            when 'EV stock' then cast(cast(value as decimal(15,1)) as double)
                            when 'EV stock share' then cast(cast(value as decimal(10,6)) as double)
                            when 'Electricity demand' then cast(cast(value as decimal(10,2)) as double)
                            when 'Oil displacement Mbd' then cast(cast(round(value) as bigint) as double) end, 6) as value
from evf""",
    "time_bands": f"""
select cast(year as bigint) as year, {HALF} as half_decade, {PANDEMIC} as pandemic_period,
       case when year <= 2014 then '2010-2014' when year <= 2019 then '2015-2019' else '2020-2023' end as half_decade_source,
       case when year <= 2019 then 'Pre-Pandemic' when year <= 2021 then 'Pandemic' else 'Post-Pandemic' end as pandemic_period_source
from year_dim""",
    "star_join": """
select c.country, c.continent, cast(y.year as bigint) as year, y.pandemic_period, m.vehicle_type, m.powertrain,
       cast(m.ev_sales as bigint) as ev_sales, round(cast(m.ev_stock as double), 6) as ev_stock
from ev_market m join country_dim c on m.key_c = c.key_c join year_dim y on m.key_y = y.key_y""",
    "sort_nulls": """
select cast(e.year as bigint) as year, e.country, round(cast(e.renewable_generation as double), 6) as renewable_generation,
       cast(row_number() over (partition by e.year order by e.renewable_generation desc nulls first, e.country asc nulls last) as bigint) as pos
from energy_primary e""",
    "clean_tables": f"""with {CL}, {WB}, {PF}, {PS}, {STOCK}, {CO2}, {ENERGY},
market as (
  select pf.*, wb.population_wb, wb.gdp_wb, m.continent, m.continent_code from pf
  left join wb on pf.iso_code = wb.iso_code and pf.year = wb.year left join country_dim m on pf.iso_code = m.iso_code
  where coalesce(ev_sales, ev_stock, ev_sales_share, ev_stock_share, ev_electricity_demand) is not null)
select 'market_clean' as table_name, cast(count(*) as bigint) as rows, cast(12 * count(*) + count(continent) + count(continent_code) + count(population_wb) + count(gdp_wb) as bigint) as filled,
       cast(sum(year) as bigint) as year_sum from market
union all
select 'infra_clean', count(*), 9 * count(*) + count(m.continent) + count(m.continent_code), sum(year) from infra i left join country_dim m on i.iso_code = m.iso_code
union all
select 'co2_clean', count(*), 5 * count(*) + count(m.continent) + count(m.continent_code) + {" + ".join(f"count(o.{c})" for c in CO2_MEASURES)}, sum(year)
from co2c o left join country_dim m on o.iso_code = m.iso_code
union all
select 'energy_clean', count(*), 5 * count(*) + count(m.continent) + count(m.continent_code) + {" + ".join(f"count(e.{c})" for c in ("population", "gdp", *ENERGY_MEASURES))}, sum(year)
from energy e left join country_dim m on e.iso_code = m.iso_code""",
}
