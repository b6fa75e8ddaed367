"""DuckDB oracle statements for the model, sink, check and timing keys."""

from __future__ import annotations

from voltcube.functions.scalar import exact_mean_sql
from voltcube import schema as S
from voltcube.plans.oracle_cleaning import CL, CO2, ENERGY, HALF, PANDEMIC, PF, PS, STOCK, WB
from voltcube.plans.roles import ENERGY_MEASURES

PFX = """pfx as (select * from pf
  where coalesce(ev_sales, ev_stock, ev_sales_share, ev_stock_share, ev_electricity_demand) is not null)"""

DIMS = """dsrc as (select iso_code, year, country, 0 as src from pfx union all select iso_code, year, country, 1 from co2c),
cd as (
  select row_number() over (order by iso_code) as key_c, iso_code, country
  from (select iso_code, arg_min(country, (src, country, year)) as country from dsrc where iso_code is not null group by iso_code) d),
yd as (select row_number() over (order by year) as key_y, year from (select distinct year from dsrc) t),
vd as (select row_number() over (order by vehicle_type) as key_v, vehicle_type from (select distinct vehicle_type from pfx) t),
pd as (select row_number() over (order by powertrain) as key_p, powertrain from (select distinct powertrain from pfx) t)"""

BASE = f"with {CL}, {WB}, {PF}, {PFX}, {PS}, {STOCK}, {CO2}, {ENERGY}, {DIMS}"


def _num(c: str, t: str) -> str:
    """A clean value in the fact's type, then as a double."""
    return f"round(cast(cast({c} as {t}) as double), 6) as {c}"


def _fact(src: str, cols: dict) -> str:
    """Keyed rows; of rows with the same keys the last by (country, year)."""
    values = ", ".join(f"cast(round({c}) as bigint) as {c}" if t == "bigint" else _num(c, t) for c, t in cols.items())
    return f"""{BASE}
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, {values}
from (select f.*, cd.key_c, yd.key_y from {src} f join cd on f.iso_code = cd.iso_code join yd on f.year = yd.year
      qualify row_number() over (partition by cd.key_c, yd.key_y order by f.country desc, f.year desc) = 1) k"""


def _skip(name: str, src: str, extra_join: str = "", extra_ok: str = "") -> str:
    ok = f"cd.key_c is not null and yd.key_y is not null{extra_ok}"
    return f"""select '{name}' as fact_name,
       cast(count(*) filter (where {ok}) as bigint) as loaded,
       cast(count(*) filter (where not coalesce({ok}, false)) as bigint) as skipped
from {src} f left join cd on f.iso_code = cd.iso_code left join yd on f.year = yd.year {extra_join}"""


def _mean(col: str, variant: str) -> str:
    """Exact mean of whole microseconds, half up to 6 decimals."""
    v = f"case when variant = '{variant}' then cast({col} as decimal(18,3)) end"
    return exact_mean_sql(f"({v})", 3, out_scale=6)


_TIMING = f"""with g as (
  select query_id, {_mean('total_ms', 'A')} as a_total_ms, {_mean('total_ms', 'B')} as b_total_ms,
         {_mean('planning_ms', 'A')} as a_planning_ms, {_mean('planning_ms', 'B')} as b_planning_ms, max(total_ms) as mx
  from run_timing group by query_id)
select query_id, a_total_ms, b_total_ms, round(case when b_total_ms = 0 then null else a_total_ms / b_total_ms end, 6) as ratio,
       a_planning_ms, b_planning_ms, round(mx, 6) as max_total_ms from g"""


def _seeded_checks() -> str:
    """Every constraint counted on the tables with the seeded violations."""
    rows = []

    def add(table, rule, sql):
        rows.append(f"select '{table}' as table_name, '{rule}' as rule, cast(({sql}) as bigint) as violations")

    for table, (schema, pk, unique, fks) in S.TABLES.items():
        t = f"s_{table}"
        for f in schema.fields:
            if not f.nullable:
                add(table, f"{f.name}_not_null", f"select count(*) from {t} where {f.name} is null")
            if f.name in S.TEXT_LENGTHS:
                add(table, f"{f.name}_length", f"select count(*) from {t} where length({f.name}) > {S.TEXT_LENGTHS[f.name]}")
            if f.dataType.typeName() == "decimal":
                add(table, f"{f.name}_range", f"select count(*) from {t} where abs(cast({f.name} as double)) > {S.decimal_bound(f.dataType)!r}")
        add(table, "primary_key", f"select count(*) from (select 1 from {t} group by {', '.join(pk)} having count(*) > 1)")
        for u in unique:
            add(table, f"{u}_unique", f"select count(*) from (select 1 from {t} where {u} is not null group by {u} having count(*) > 1)")
        for c, dim in fks.items():
            add(table, f"{c}_references_{dim}", f"select count(*) from {t} where {c} is not null and {c} not in (select {c} from s_{dim} where {c} is not null)")
    return """with s_country_dim as (
  select key_c, case when key_c % 7 = 0 then null when key_c % 7 = 2 then repeat(country, 9) else country end as country,
         case when key_c % 7 = 1 then 'N999' else iso_code end as iso_code, continent, continent_code from country_dim),
s_year_dim as (
  select key_y, case when key_y = 2 then year - 1 else year end as year, half_decade, case when key_y = 1 then null else pandemic_period end as pandemic_period from year_dim),
labels as (
  select m.*, dense_rank() over (order by vehicle_type) as key_v, dense_rank() over (order by powertrain) as key_p from ev_market m),
s_vehicle_type_dim as (
  select distinct key_v, vehicle_type from labels union all select distinct key_v, vehicle_type from labels where key_v = 1),
s_powertrain_dim as (select distinct key_p, powertrain from labels where key_p <> 3),
s_ev_market as (
  select * replace (cast(ev_sales_share as double) * case when key_y = 4 then 1e6 else 1 end as ev_sales_share) from labels),
s_ev_infrastructure as (select * from ev_infrastructure union all select * from ev_infrastructure where key_c % 7 = 0),
s_country_energy as (select * replace (case when key_c % 7 = 3 then key_c + 100 else key_c end as key_c) from country_energy),
s_country_macro as (select * replace (case when key_y = 7 then null else key_y end as key_y) from country_macro)
""" + "\nunion all\n".join(rows)


MODEL = {
    "dim_build": f"""{BASE}
select cast(cd.key_c as bigint) as key_c, cd.iso_code, cd.country, m.continent, m.continent_code
from cd left join country_dim m on cd.iso_code = m.iso_code""",
    "year_dim_build": f"""{BASE}
select cast(key_y as bigint) as key_y, cast(year as bigint) as year, {HALF} as half_decade, {PANDEMIC} as pandemic_period from yd""",
    "key_resolve": f"""{BASE}
select cast(cd.key_c as bigint) as key_c, cast(yd.key_y as bigint) as key_y, cast(vd.key_v as bigint) as key_v,
       cast(pd.key_p as bigint) as key_p, cast(round(coalesce(p.ev_sales, 0)) as bigint) as ev_sales,
       round(cast(cast(coalesce(p.ev_sales_share, 0) as decimal(10,6)) as double), 6) as ev_sales_share,
       round(cast(cast(coalesce(p.ev_stock, 0) as decimal(15,1)) as double), 6) as ev_stock,
       round(cast(cast(coalesce(p.ev_stock_share, 0) as decimal(10,6)) as double), 6) as ev_stock_share,
       round(cast(cast(coalesce(p.ev_electricity_demand, 0) as decimal(10,2)) as double), 6) as ev_electricity_demand
from pfx p join cd on p.iso_code = cd.iso_code join yd on p.year = yd.year
join vd on p.vehicle_type = vd.vehicle_type join pd on p.powertrain = pd.powertrain""",
    "key_resolve_infra": _fact("infra", {"ev_charging_points": "bigint", "fast_charging_points": "bigint", "slow_charging_points": "bigint",
                                         "charging_points_per_ev": "decimal(10,4)"}),
    "key_resolve_energy": _fact("energy", {c: "decimal(18,4)" for c in ENERGY_MEASURES}),
    "key_resolve_macro": _fact("co2c", {"population": "bigint", "gdp": "decimal(18,2)"} | {c: "decimal(18,4)" for c in (
        "co2_emissions", "co2_per_capita", "co2_per_gdp", "oil_co2", "oil_co2_per_capita", "coal_co2", "coal_co2_per_capita", "co2_per_unit_energy")}),
    "pipeline_rank_stock": f"""{BASE}
select cast(p.year as bigint) as year, cd.country, round(cast(sum(cast(coalesce(p.ev_stock, 0) as decimal(15,1))) as double), 6) as stock,
       cast(rank() over (partition by p.year order by sum(cast(coalesce(p.ev_stock, 0) as decimal(15,1))) desc) as bigint) as ranking
from pfx p join cd on p.iso_code = cd.iso_code group by p.year, cd.country""",
    "upsert_market": """with lab as (
  select m.*, dense_rank() over (order by vehicle_type) as key_v, dense_rank() over (order by powertrain) as key_p from ev_market m)
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, cast(key_v as bigint) as key_v, cast(key_p as bigint) as key_p,
       cast(case when key_y = 3 then ev_sales + 1 else ev_sales end as bigint) as ev_sales, round(cast(ev_stock as double), 6) as ev_stock from lab
union all
select key_c, 8, key_v, key_p, ev_sales, round(cast(ev_stock as double), 6) from lab where key_y = 3""",
    "key_skips": f"""{BASE}
{_skip('ev_market', 'pfx', 'left join vd on f.vehicle_type = vd.vehicle_type left join pd on f.powertrain = pd.powertrain',
       ' and vd.key_v is not null and pd.key_p is not null')}
union all
{_skip('ev_infrastructure', 'ps')}
union all
{_skip('country_energy', 'energy')}
union all
{_skip('country_macro', 'co2c')}""",
    "coverage_gap": f"""{BASE}
select 'ev_infrastructure' as missing_in, iso_code, cast(year as bigint) as year
from (select iso_code, year from pfx except select iso_code, year from ps) a
union all
select 'co2', iso_code, cast(year as bigint) from (select iso_code, year from pfx except select iso_code, year from co2c) b
union all
select 'energy', iso_code, cast(year as bigint) from (select iso_code, year from pfx except select iso_code, year from energy) c""",
    "load_rejects": """
select 'ev_market' as table_name, 'ev_sales_range' as rule, cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, '1.0E25' as came from ev_market where key_c % 7 = 2 and key_y = 3
union all select 'ev_market', 'key_v_not_null', key_c, key_y, null from ev_market where key_c % 7 = 3 and key_y = 2
union all select 'country_energy', 'net_imports_range', key_c, key_y, 'NaN' from country_energy where key_y = 5
union all select 'country_dim', 'iso_code_length', key_c, null, 'N999' from country_dim where key_c % 7 = 1""",
    "load_increment": f"""{BASE}, control as (
  select 'ev_market' as fact_name, iso_code, year, vehicle_type, powertrain, country, coalesce(round(ev_sales), 0) as v from pfx
  union all select 'ev_infrastructure', iso_code, year, null, null, country, round(ev_charging_points) from infra
  union all select 'country_energy', iso_code, year, null, null, country, cast(electricity_generation as decimal(18,4)) from energy
  union all select 'country_macro', iso_code, year, null, null, country, cast(co2_emissions as decimal(18,4)) from co2c),
known as (
  select * from control where iso_code in (select iso_code from cd) and year in (select year from yd)
  qualify row_number() over (partition by fact_name, iso_code, year, vehicle_type, powertrain order by country desc) = 1)
select fact_name, iso_code, cast(year as bigint) as year, cast(case when year >= 1998 then 2 else 1 end as bigint) as load,
       cast(count(*) as bigint) as n, round(cast(sum(v) as double), 6) as total
from known group by fact_name, iso_code, year""",
    "dim_reload": f"""{BASE}, labels as (
  select 'country_dim' as dim_name, iso_code as label, max(case when iso_code > 'N04' and year > 1995 and src_ok then 1 else 0 end) as early from (
      select iso_code, year, vehicle_type >= 'F' as src_ok from pfx union all select iso_code, year, true from co2c) s where iso_code is not null group by iso_code
  union all select 'year_dim', cast(year as varchar), max(case when iso_code > 'N04' and year > 1995 and src_ok then 1 else 0 end) from (
      select iso_code, year, vehicle_type >= 'F' as src_ok from pfx union all select iso_code, year, true from co2c) s group by year
  union all select 'vehicle_type_dim', vehicle_type, max(case when iso_code > 'N04' and year > 1995 and vehicle_type >= 'F' then 1 else 0 end) from pfx group by vehicle_type
  union all select 'powertrain_dim', powertrain, max(case when iso_code > 'N04' and year > 1995 and vehicle_type >= 'F' then 1 else 0 end) from pfx group by powertrain)
select dim_name, label, case when early = 1 then cast(row_number() over (partition by dim_name, early order by label) as bigint) end as first_key,
       cast(row_number() over (partition by dim_name order by early desc, label) as bigint) as key
from labels""",
    "upsert_years": """with lab as (
  select m.*, dense_rank() over (order by vehicle_type) as key_v, dense_rank() over (order by powertrain) as key_p from ev_market m)
select cast(key_c as bigint) as key_c, cast(y as bigint) as key_y, cast(key_v as bigint) as key_v, cast(key_p as bigint) as key_p,
       cast(case when y = 3 then 2 * ev_sales else ev_sales end as bigint) as ev_sales, round(cast(ev_stock as double), 6) as ev_stock,
       cast(case when y in (3, 8) then 2 else 1 end as bigint) as load
from (select *, unnest(case when key_y = 3 then [3, 8] else [key_y] end) as y from lab) l""",
    "upsert_fact": """with upd as (
  select key_c, key_y, ev_charging_points + 1 as ev_charging_points, fast_charging_points + 1 as fast_charging_points,
         slow_charging_points + 1 as slow_charging_points from ev_infrastructure where key_y = 3
  union all
  select key_c, 8, ev_charging_points, fast_charging_points, slow_charging_points from ev_infrastructure where key_y = 3),
merged as (
  select * from upd
  union all
  select t.* exclude (charging_points_per_ev) from ev_infrastructure t where not exists (select 1 from upd u where u.key_c = t.key_c and u.key_y = t.key_y))
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, cast(ev_charging_points as bigint) as ev_charging_points,
       cast(fast_charging_points as bigint) as fast_charging_points, cast(slow_charging_points as bigint) as slow_charging_points
from merged""",
    "insert_absent": """
select iso_code, country, continent from country_dim where key_c < 20
union all
select n.iso_code, lower(n.country), n.continent from country_dim n
where not exists (select 1 from country_dim t where t.key_c < 20 and t.iso_code = n.iso_code)""",
    "publish_snapshot": """
select 'country_dim' as table_name, cast(count(*) as bigint) as rows from country_dim
union all select 'year_dim', cast(count(*) as bigint) from year_dim
union all select 'vehicle_type_dim', cast(count(distinct vehicle_type) as bigint) from ev_market
union all select 'powertrain_dim', cast(count(distinct powertrain) as bigint) from ev_market
union all select 'ev_market', cast(count(*) as bigint) from ev_market
union all select 'ev_infrastructure', cast(count(*) as bigint) from ev_infrastructure
union all select 'country_energy', cast(count(*) as bigint) from country_energy
union all select 'country_macro', cast(count(*) as bigint) from country_macro""",
    "sink_roundtrip": """
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, cast(ev_charging_points as bigint) as ev_charging_points,
       cast(fast_charging_points as bigint) as fast_charging_points, cast(slow_charging_points as bigint) as slow_charging_points
from ev_infrastructure""",
    "scan_csv": """
select cast(key_c as bigint) as key_c, country, iso_code, continent, continent_code from country_dim""",
    "check_unique": """with seeded as (
  select key_c, key_y from ev_infrastructure
  union all select key_c, key_y from ev_infrastructure where key_c % 7 = 0)
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y, cast(count(*) as bigint) as n
from seeded group by key_c, key_y having count(*) > 1""",
    "check_fk": """with e as (
  select case when key_c % 7 = 0 then key_c + 100 else key_c end as key_c, key_y from country_energy)
select cast(key_c as bigint) as key_c, cast(key_y as bigint) as key_y from e
where key_c is not null and not exists (select 1 from country_dim d where d.key_c = e.key_c)""",
    "check_domain": """with cd as (
  select key_c, case when key_c % 7 = 0 then null else country end as country,
         case when key_c % 7 = 1 then iso_code || 'X' else iso_code end as iso_code, continent, continent_code
  from country_dim)
select 'country_dim' as table_name, 'country_not_null' as rule, cast(count(*) filter (where country is null) as bigint) as violations from cd
union all select 'country_dim', 'iso_code_not_null', cast(count(*) filter (where iso_code is null) as bigint) from cd
union all select 'country_dim', 'iso_code_length', cast(count(*) filter (where length(iso_code) > 3) as bigint) from cd
union all select 'country_dim', 'continent_code_length', cast(count(*) filter (where length(continent_code) > 2) as bigint) from cd
union all select 'ev_market', 'ev_sales_not_null', cast(count(*) filter (where ev_sales is null) as bigint) from ev_market
union all select 'ev_market', 'ev_sales_share_range',
          cast(count(*) filter (where abs(cast(ev_sales_share as double)) > 9999.999999) as bigint) from ev_market
union all select 'ev_market', 'ev_stock_negative', cast(count(*) filter (where cast(ev_stock as double) < 0) as bigint) from ev_market""",
    "profile_table": f"""{BASE}
select 'ev_market' as table_name, cast(count(*) as bigint) as rows, cast(count(*) filter (where iso_code is null) as bigint) as null_keys,
       cast(min(year) as bigint) as min_year, cast(max(year) as bigint) as max_year from pfx
union all select 'ev_infrastructure', cast(count(*) as bigint), cast(count(*) filter (where iso_code is null) as bigint),
       cast(min(year) as bigint), cast(max(year) as bigint) from ps
union all select 'co2', cast(count(*) as bigint), cast(count(*) filter (where iso_code is null) as bigint),
       cast(min(year) as bigint), cast(max(year) as bigint) from co2c
union all select 'energy', cast(count(*) as bigint), cast(count(*) filter (where iso_code is null) as bigint),
       cast(min(year) as bigint), cast(max(year) as bigint) from energy""",
    "measure_agg": f"""
select c.continent, cast(y.year as bigint) as year,
       round(cast(sum(m.ev_sales) as double), 6) as ev_sales,
       {exact_mean_sql('m.ev_sales_share', 6)} as ev_sales_share,
       round(cast(sum(m.ev_stock) as double), 6) as ev_stock,
       {exact_mean_sql('m.ev_stock_share', 6)} as ev_stock_share,
       round(cast(sum(m.ev_electricity_demand) as double), 6) as ev_electricity_demand
from ev_market m join country_dim c on m.key_c = c.key_c join year_dim y on m.key_y = y.key_y
group by c.continent, y.year""",
    "publish_checks": _seeded_checks(),
    "variant_ratio": _TIMING,
    "results_table": _TIMING,
}
