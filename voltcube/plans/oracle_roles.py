"""DuckDB oracle SQL for every query key.

``ROLE_PREFIX`` is the role-table SQL of FIXTURES.md section 4 (valid in DuckDB
and Spark SQL) plus the ``raw_co2`` shape; each query is ``WITH`` + prefix +
its own CTEs and final SELECT. Outputs are cast to bigint / double / string
and aliased exactly as the Spark side.
"""

ROLE_PREFIX = """
country_dim as (
  select n_nationkey as key_c, n_name as country,
         concat('N', lpad(cast(n_nationkey as string), 2, '0')) as iso_code,
         case when n_nationkey = 24 then null else r_name end as continent,
         case when n_nationkey = 24 then null when r_name = 'AMERICA' then 'NA' else substr(r_name, 1, 2) end as continent_code
  from nation join region on n_regionkey = r_regionkey),
year_dim as (
  select distinct cast(year(o_orderdate) as int) - 1994 as key_y, cast(year(o_orderdate) as int) as year,
         case when year(o_orderdate) <= 1996 then '1995-1996' when year(o_orderdate) <= 1998 then '1997-1998' else '1999-2001' end as half_decade,
         case when year(o_orderdate) < 1998 then 'Pre-Pandemic' when year(o_orderdate) <= 1999 then 'Pandemic' else 'Post-Pandemic' end as pandemic_period
  from orders),
market_base as (
  select c_nationkey as key_c, cast(year(o_orderdate) as int) - 1994 as key_y, p_type as vehicle_type, l_returnflag as powertrain,
         cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) as q,
         cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as p,
         cast(sum(case when l_linestatus = 'F' then cast(l_tax as decimal(18,2)) else cast(0 as decimal(18,2)) end) as decimal(18,2)) as d
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
  group by 1, 2, 3, 4),
ev_market as (
  select key_c, key_y, vehicle_type, powertrain, cast(q as bigint) as ev_sales,
         cast(p as decimal(15,1)) as ev_stock,
         cast(round(100 * cast(q as double) / cast(sum(q) over (partition by key_y) as double), 6) as decimal(10,6)) as ev_sales_share,
         cast(round(100 * cast(p as double) / cast(sum(p) over (partition by key_y) as double), 6) as decimal(10,6)) as ev_stock_share,
         cast(d as decimal(10,2)) as ev_electricity_demand
  from market_base),
nation_year as (
  select c_nationkey as key_c, cast(year(o_orderdate) as int) - 1994 as key_y, count(distinct o_custkey) as customers, count(*) as n,
         cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as price,
         count(case when o_orderstatus = 'F' then 1 end) as n_f, count(case when o_orderstatus = 'O' then 1 end) as n_o,
         count(case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1 end) as n_fast
  from orders join customer on o_custkey = c_custkey group by 1, 2),
ev_infrastructure as (
  select n.key_c, n.key_y, n_f + n_o as ev_charging_points, n_f as fast_charging_points, n_o as slow_charging_points,
         cast(round(cast(n_f + n_o as double) / cast(sold as double), 4) as decimal(10,4)) as charging_points_per_ev
  from nation_year n left join (select key_c, key_y, sum(q) as sold from market_base group by key_c, key_y) m on n.key_c = m.key_c and n.key_y = m.key_y
  where not (n.key_c % 4 = 1 and n.key_y = 4)),
shipped as (
  select s_nationkey as key_c, cast(year(l_shipdate) as int) - 1994 as key_y, l_linestatus as st, l_returnflag as fl, l_discount as dc,
         cast(l_quantity as decimal(18,4)) as q, cast(l_tax as decimal(4,2)) as tax
  from lineitem join supplier on l_suppkey = s_suppkey),
country_energy as (
  select key_c, key_y,
         cast(sum(cast(q * (1 + tax) as decimal(18,4))) as decimal(18,4)) as energy_consumption,
         cast(sum(cast(q * (1 - cast(dc as decimal(4,2))) as decimal(18,4))) as decimal(18,4)) as electricity_demand,
         cast(sum(case when key_c <> 5 then q else 0 end) as decimal(18,4)) as electricity_generation,
         cast(sum(case when key_c <> 5 and st = 'F' then q else 0 end) as decimal(18,4)) as fossil_generation,
         cast(sum(case when key_c <> 5 and st = 'F' and fl = 'A' then q else 0 end) as decimal(18,4)) as coal_generation,
         cast(sum(case when key_c <> 5 and st = 'F' and fl = 'R' then q else 0 end) as decimal(18,4)) as oil_generation,
         cast(sum(case when key_c <> 5 and st = 'F' and fl = 'N' then q else 0 end) as decimal(18,4)) as gas_generation,
         cast(sum(case when key_c <> 5 and st = 'O' then q else 0 end) as decimal(18,4)) as renewable_generation,
         cast(sum(case when key_c <> 5 and (st = 'O' or dc >= 0.08) then q else 0 end) as decimal(18,4)) as low_carbon_generation,
         cast(sum(case when key_c <> 5 and st = 'O' and fl = 'A' then q else 0 end) as decimal(18,4)) as wind_generation,
         cast(sum(case when key_c <> 5 and st = 'O' and fl = 'N' then q else 0 end) as decimal(18,4)) as hydro_generation,
         cast(sum(case when key_c <> 5 and st = 'F' and dc >= 0.08 then q else 0 end) as decimal(18,4)) as nuclear_generation,
         cast(sum(case when key_c <> 5 and st = 'O' and dc < 0.02 then q else 0 end) as decimal(18,4)) as other_generation,
         cast(sum(case when key_c <> 5 and st = 'O' and fl = 'R' then q else 0 end) as decimal(18,4)) as solar_generation,
         cast(sum(cast(q * (1 - cast(dc as decimal(4,2))) as decimal(18,4))) - sum(case when key_c <> 5 then q else 0 end) as decimal(18,4)) as net_imports
  from shipped group by key_c, key_y),
country_macro as (
  select key_c, key_y, customers as population, gdp, cast(n as decimal(18,4)) as co2_emissions,
         cast(round(cast(n as double) / customers, 4) as decimal(18,4)) as co2_per_capita,
         cast(round(cast(n * 1000000 as double) / cast(gdp as double), 4) as decimal(18,4)) as co2_per_gdp,
         cast(n_f as decimal(18,4)) as oil_co2, cast(round(cast(n_f as double) / customers, 4) as decimal(18,4)) as oil_co2_per_capita,
         cast(n_o as decimal(18,4)) as coal_co2, cast(round(cast(n_o as double) / customers, 4) as decimal(18,4)) as coal_co2_per_capita,
         case when n_fast <> 0 then cast(round(cast(n as double) / cast(n_fast as double), 4) as decimal(18,4)) end as co2_per_unit_energy,
         cast(n_fast as decimal(18,4)) as primary_energy_consumption
  from (select *, case when key_c = 7 then null else price end as gdp from nation_year) m),
dirty_name as (
  select key_c, case when key_c = 10 then concat(chr(9), lower(country), chr(10)) when key_c = 20 then concat(chr(160), lower(country)) else
                case key_c % 5 when 0 then lower(country) when 1 then iso_code
                when 2 then concat(country, ' Republic') when 3 then concat('Kingdom of ', country) else concat(country, 'x') end end as region
  from country_dim),
raw_ev as (
  select row_number() over (order by region, year, mode, powertrain, parameter, dup) as seq,
         region, category, parameter, mode, powertrain, year, value
  from (
    select region, case when key_y = 7 then 'Projection-STEPS' else 'Historical' end as category,
           parameter, mode, powertrain, key_y + 1994 as year, dup, value
    from (
      select key_c, key_y, vehicle_type as mode, powertrain, 'EV sales' as parameter, 0 as dup, cast(ev_sales as double) as value from ev_market
      union all select key_c, key_y, vehicle_type, powertrain, 'EV sales', 1, cast(ev_sales + 1 as double) from ev_market where key_c = 2
      union all select key_c, key_y, vehicle_type, powertrain, 'EV stock', 0, cast(ev_stock as double) from ev_market
      union all select key_c, key_y, vehicle_type, powertrain, 'EV stock share', 0, cast(ev_stock_share as double) from ev_market where key_c % 3 <> 0
      union all select key_c, key_y, vehicle_type, powertrain, 'Electricity demand', 0, cast(ev_electricity_demand as double) from ev_market
      union all select key_c, key_y, vehicle_type, powertrain, 'Oil displacement Mbd', 0, cast(ev_sales as double) / 10 from ev_market
      union all select key_c, key_y, 'EV', 'Publicly available fast', 'EV charging points', 0, cast(fast_charging_points as double) from ev_infrastructure
      union all select key_c, key_y, 'EV', 'Publicly available slow', 'EV charging points', 0, cast(slow_charging_points as double) from ev_infrastructure
    ) u join dirty_name using (key_c) where key_c not in (22, 23)
    union all
    select 'World', 'Historical', 'EV sales', vehicle_type, powertrain, key_y + 1994, 0, cast(sum(ev_sales) as double)
    from ev_market group by vehicle_type, powertrain, key_y) r),
energy_primary as (
  select c.country, c.iso_code, e.key_y + 1994 as year, cast(m.population as double) as population, cast(m.gdp as double) as gdp,
         e.energy_consumption,
         e.electricity_generation,
         case when (e.key_c + e.key_y) % 7 = 0 then null else e.electricity_demand end as electricity_demand,
         case when (e.key_c + e.key_y) % 5 = 0 then null else e.fossil_generation end as fossil_generation,
         case when (e.key_c + e.key_y) % 7 = 1 then null else e.coal_generation end as coal_generation,
         e.oil_generation,
         case when (e.key_c + e.key_y) % 7 = 2 then null else e.gas_generation end as gas_generation,
         case when (e.key_c + e.key_y) % 6 = 0 then null else e.renewable_generation end as renewable_generation,
         case when (e.key_c + e.key_y) % 7 = 3 then null else e.low_carbon_generation end as low_carbon_generation,
         case when (e.key_c + e.key_y) % 7 = 4 then null else e.wind_generation end as wind_generation,
         case when (e.key_c + e.key_y) % 7 = 5 then null else e.hydro_generation end as hydro_generation,
         case when (e.key_c + e.key_y) % 7 = 6 then null else e.nuclear_generation end as nuclear_generation,
         e.other_generation,
         case when (e.key_c + e.key_y) % 7 = 0 then null else e.solar_generation end as solar_generation,
         case when (e.key_c + e.key_y) % 7 = 1 then null else e.net_imports end as net_imports
  from country_energy e join country_dim c on e.key_c = c.key_c left join country_macro m on e.key_c = m.key_c and e.key_y = m.key_y),
raw_generation as (
  select iso_code, key_y + 1994 as year, 'Country or economy' as area_type, source, generation + 10 * seq as generation, seq
  from (
    select * from (
      select key_c, key_y, 'Total generation' as source, cast(electricity_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Demand' as source, cast(electricity_demand as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Fossil' as source, cast(fossil_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Coal' as source, cast(coal_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Gas' as source, cast(gas_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Renewables' as source, cast(renewable_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Clean' as source, cast(low_carbon_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Wind' as source, cast(wind_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Hydro' as source, cast(hydro_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Nuclear' as source, cast(nuclear_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Solar' as source, cast(solar_generation as double) + 1 as generation from country_energy
      union all select key_c, key_y, 'Net imports' as source, cast(net_imports as double) + 1 as generation from country_energy) g
    join (select 0 as seq union all select 1) twice on seq = 0 or key_c = 2) e
  join country_dim c on e.key_c = c.key_c where e.key_c <> 9
  union all
  select 'N00', key_y + 1994, 'Region', 'Fossil', cast(sum(fossil_generation) as double), 0 from country_energy group by key_y),
raw_macro as (
  select iso_code, 'NY.GDP.MKTP.CD' as series_code, 0 as seq,
         coalesce(max(case when key_y = 1 then cast(gdp as string) end), '..') as "1995 [YR1995]", max(case when key_y = 2 then cast(gdp as string) end) as "1996 [YR1996]", max(case when key_y = 3 then cast(gdp as string) end) as "1997 [YR1997]", max(case when key_y = 4 then cast(gdp as string) end) as "1998 [YR1998]", max(case when key_y = 5 then cast(gdp as string) end) as "1999 [YR1999]", max(case when key_y = 6 then cast(gdp as string) end) as "2000 [YR2000]", max(case when key_y = 7 then cast(gdp as string) end) as "2001 [YR2001]"
  from country_macro m join country_dim c on m.key_c = c.key_c group by iso_code
  union all
  select iso_code, 'SP.POP.TOTL', 0, max(case when key_y = 1 then cast(population as string) end), '..', max(case when key_y = 3 then cast(population as string) end), max(case when key_y = 4 then cast(population as string) end), max(case when key_y = 5 then cast(population as string) end), max(case when key_y = 6 then cast(population as string) end), max(case when key_y = 7 then cast(population as string) end)
  from country_macro m join country_dim c on m.key_c = c.key_c group by iso_code
  union all
  select iso_code, 'SP.POP.TOTL', 1, concat('9', max(case when key_y = 1 then cast(population as string) end)), max(case when key_y = 2 then cast(population as string) end), concat('9', max(case when key_y = 3 then cast(population as string) end)), concat('9', max(case when key_y = 4 then cast(population as string) end)), concat('9', max(case when key_y = 5 then cast(population as string) end)), concat('9', max(case when key_y = 6 then cast(population as string) end)), concat('9', max(case when key_y = 7 then cast(population as string) end))
  from country_macro m join country_dim c on m.key_c = c.key_c where m.key_c = 3 group by iso_code),
run_timing as (
  select event_id, event_type as query_id, case when event_id % 2 = 0 then 'A' else 'B' end as variant, value as total_ms,
         case when event_id % 97 = 0 then null else value / 10 end as planning_ms
  from events),
raw_co2 as (
  select case when twice then concat('A ', c.country) else c.country end as country, m.key_y + 1994 as year, c.iso_code,
         cast(m.population as double) as population, cast(m.gdp as double) as gdp, cast(m.co2_emissions as double) as co2,
         cast(m.co2_per_capita as double) as co2_per_capita, cast(m.co2_per_gdp as double) as co2_per_gdp,
         cast(m.oil_co2 as double) as oil_co2, cast(m.oil_co2_per_capita as double) as oil_co2_per_capita,
         cast(m.coal_co2 as double) as coal_co2, cast(m.coal_co2_per_capita as double) as coal_co2_per_capita,
         cast(m.co2_per_unit_energy as double) as co2_per_unit_energy, cast(m.primary_energy_consumption as double) as primary_energy_consumption
  from country_macro m join country_dim c on m.key_c = c.key_c
  join (select false as twice union all select true) t on not twice or (m.key_c = 22 and m.key_y = 1)
  where m.key_c <> 23)
"""


def with_roles(body: str) -> str:
    """Full oracle statement: the role CTEs, optional extra CTEs, final query."""
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + ROLE_PREFIX.strip() + ",\n" + body[5:]
    return "with " + ROLE_PREFIX.strip() + "\n" + body
