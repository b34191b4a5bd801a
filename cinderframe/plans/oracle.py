"""DuckDB oracle SQL for every registered query.

Written from the survey's formulas, with its own literals and shapes: unit conversion is a
lookup joined on the sensor, the daily figures of all scopes come from one pass with filtered
aggregates, benchmarks are picked by filtered aggregates.  Nothing is imported from the code
that it checks.  Doubles are rounded through ``decimal(28,10)`` (half away from zero) and
decimals are returned as doubles, as the Spark side does.
"""

from __future__ import annotations

AS_OF = "date '2001-10-31'"
RUN_TS = "timestamp '2001-11-05 00:00:00'"


def _r(expr: str, n: int) -> str:
    return f"cast(round(cast({expr} as decimal(28,10)), {n}) as double)"


RAW_SENSOR = """
select cast(l_shipdate as date) as reading_date,
       concat('PLANT_', lpad(cast(l_suppkey % 10 as varchar), 2, '0')) as plant_id,
       s.sensor, v.value, s.unit_label, v.value < s.lo or v.value > s.hi as is_anomaly,
       l_shipdate as ingested_at
from lineitem
join (values (1, 'CO2_emission_intensity', 680e0, 150e0, 600e0, 800e0, 'kg_CO2_per_t_cement'),
             (2, 'specific_heat_consumption', 750e0, 100e0, 680e0, 820e0, 'kcal_per_kg_clinker'),
             (3, 'coal_consumption_rate', 10.2e0, 6e0, 5e0, 15e0, 't_per_hr'),
             (4, 'NOx_emission', 380e0, 450e0, 0e0, 800e0, 'mg_per_Nm3'),
             (5, 'dust_emission', 12e0, 15e0, 0e0, 20e0, 'mg_per_Nm3'),
             (6, 'SO2_emission', 45e0, 60e0, 0e0, 200e0, 'mg_per_Nm3'),
             (7, 'O2_flue_gas', 2.5e0, 2e0, 1e0, 5e0, 'pct')
     ) s(n, sensor, base, span, lo, hi, unit_label) on l_linenumber = s.n,
lateral (select s.base + s.span * ((l_quantity - 25.0e0) / 25.0e0) as value) v
"""

# What each sensor converts to: (CO2 factors, MJ factors, tonnes a day); NULL where it doesn't.
STG_SENSOR = """
select r.reading_date, r.plant_id, r.sensor, r.value as raw_value, r.unit_label as raw_unit,
       r.is_anomaly, r.ingested_at,
       r.value * u.co2_a * u.co2_b as co2_kg_per_t,
       r.value * u.mj / 1000 as heat_mj_per_t,
       r.value * u.hours as coal_t_per_day
from raw_sensor r
join (values ('CO2_emission_intensity', 1e0, 1e0, null, null),
             ('specific_heat_consumption', 0.0946e0, 0.95e0, 4.184e0, null),
             ('coal_consumption_rate', null, null, null, 24e0),
             ('NOx_emission', null, null, null, null), ('dust_emission', null, null, null, null),
             ('SO2_emission', null, null, null, null), ('O2_flue_gas', null, null, null, null)
     ) u(sensor, co2_a, co2_b, mj, hours) on u.sensor = r.sensor
where r.value > 0
"""

PLANT_DAYS = """
select reading_date, plant_id,
       avg(co2_kg_per_t) as mean, min(co2_kg_per_t) as low, max(co2_kg_per_t) as high,
       stddev_samp(co2_kg_per_t) as spread,
       avg(heat_mj_per_t) filter (co2_kg_per_t is not null) as heat,
       sum(coal_t_per_day) filter (co2_kg_per_t is not null) as coal,
       count(co2_kg_per_t) as n, count(*) filter (is_anomaly and co2_kg_per_t is not null) as odd,
       count(*) as every, avg(raw_value) filter (sensor = 'O2_flue_gas') as o2
from stg_sensor group by all
"""

SCOPE1 = """
select reading_date, plant_id, mean as scope1_intensity_avg, low as scope1_intensity_min,
       high as scope1_intensity_max, spread as scope1_intensity_std, heat as heat_consumption_avg,
       coal as coal_total_t_day, n as reading_count, odd as anomaly_count,
       avg(mean) over (partition by plant_id order by reading_date rows 6 preceding) as scope1_rolling_7d,
       avg(mean) over (partition by plant_id order by reading_date rows 29 preceding) as scope1_rolling_30d,
       mean - lag(mean, 30) over (partition by plant_id order by reading_date) as scope1_mom_change,
       mean > 650 as exceeds_2030_target
from plant_days where n > 0
"""

SCOPE2 = """
select reading_date, plant_id, 54.989e0 as scope2_intensity_kg_per_t,
       0.4999e0 as grid_emission_factor_kg_per_kwh, every as reading_count, o2 as o2_avg
from plant_days
"""

SCOPE3 = """
select reading_date, plant_id, 20e0 as scope3_upstream_kg_per_t, 20e0 as scope3_downstream_kg_per_t,
       40e0 as scope3_total_kg_per_t, 'industry_estimate' as data_source
from plant_days where n > 0
"""


def _mart(scope2: str) -> str:
    """The mart; ``scope2`` is the day's Scope 2 intensity, NULL where there is none."""
    return f"""
select reading_date, plant_id, {_r('scope1_intensity_avg', 2)} as scope1_kg_per_t,
       {_r('scope1_rolling_7d', 2)} as scope1_7d_avg, {_r('scope1_rolling_30d', 2)} as scope1_30d_avg,
       {_r('s2', 2)} as scope2_kg_per_t, 40e0 as scope3_kg_per_t,
       {_r('scope1_intensity_avg + s2 + 40e0', 2)} as total_co2_kg_per_t,
       reading_count, anomaly_count, exceeds_2030_target
from (select s.*, {scope2} as s2 from scope1 s join plant_days p using (reading_date, plant_id)) m
"""


MART_CO2 = _mart("54.989e0")
MART_JOINED = _mart("case when day(s.reading_date) % 3 <> 0 then 40e0 + p.every * 2.5e0 end")

RAW_IEA = """
select * from (values
    (2022, 'cement', 'Global', 'co2_intensity', 620e0), (2022, 'cement', 'Global', 'heat_consumption', 3300e0),
    (2022, 'cement', 'ASEAN', 'co2_intensity', 680e0), (2022, 'cement', 'ASEAN', 'heat_consumption', 3500e0),
    (2022, 'cement', 'Thailand', 'co2_intensity', 670e0), (2030, 'cement', 'Global', 'co2_intensity', 520e0),
    (2050, 'cement', 'Global', 'co2_intensity', 100e0), (2050, 'cement', 'SCG', 'co2_intensity', 0e0),
    (2030, 'cement', 'SCG', 'co2_intensity', 650e0)
) t(year, sector, region, metric, value)
"""

NET_ZERO = f"""
select reading_date, plant_id, scope1_kg_per_t as current_intensity,
       800 as baseline_2020, 650 as target_2030, 0 as target_2050,
       cast(cur - 650 as double) as gap_vs_2030_target, cast(cur as double) as gap_vs_2050_target,
       {_r('greatest(0, (800 - cur) / 150 * 100)', 1)} as progress_pct_to_2030,
       {_r('greatest(0, (800 - cur) / 800 * 100)', 1)} as progress_pct_to_2050,
       case when cur > 682.5 or cur is null then 'off_track' when cur > 650 then 'near_target'
            else 'on_track' end as status_2030,
       {_r('cur / nullif(2050 - year(reading_date), 0)', 2)} as required_annual_reduction
from (select *, cast(scope1_kg_per_t as decimal(28,10)) as cur from mart_co2) m
"""

BENCHMARK_GAP = f"""
select reading_date, plant_id, x as scg_intensity, b.global_avg,
       {_r('x - b.global_avg', 2)} as gap_vs_global,
       case when x < b.global_avg then 'better_than_global' else 'worse_than_global' end as global_status,
       b.asean_avg, {_r('x - b.asean_avg', 2)} as gap_vs_asean,
       b.scg_2030_target, {_r('x - b.scg_2030_target', 2)} as gap_vs_scg_target,
       case when x >= b.global_avg * 1.1 then 'bottom_10pct' when x >= b.global_avg then 'below_average'
            when x >= b.global_avg * 0.9 then 'above_average' when x is null then 'bottom_10pct'
            else 'top_10pct' end as industry_position
from (select *, scope1_kg_per_t as x from mart_co2) m,
     (select max(value) filter (year = 2022 and region = 'Global') as global_avg,
             max(value) filter (year = 2022 and region = 'ASEAN') as asean_avg,
             max(value) filter (year = 2030 and region = 'SCG') as scg_2030_target
      from raw_iea where metric = 'co2_intensity') b
"""

OWID_FIXTURE = """
select year(o_orderdate) + 14 as year, n_name as country,
       case when n_nationkey % 11 = 5 then null
            when n_nationkey % 11 = 6 then 0e0
            else cast(sum(cast(o_totalprice as decimal(18,2))) as double) / 1e6 end as co2_total_mt,
       cast(count(*) as double) / 10e0 as co2_per_capita,
       case when n_nationkey % 7 = 3 then null
            else cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) / 1e6
       end as cement_co2,
       cast(sum(case when o_orderstatus = 'O' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) / 1e6 as energy_co2
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by year(o_orderdate) + 14, n_name, n_nationkey
"""

RAW_OWID = """
select cast(year as integer) as year, country, co2_per_capita, co2_total_mt, cement_co2, energy_co2
from owid_fixture where year >= 2010 and year is not null and country is not null
"""

STG_OWID = f"""
select year, country,
       coalesce(total, 0) as co2_total_mt,
       coalesce(per_capita, 0) as co2_per_capita,
       coalesce(cement, 0) as cement_co2_mt,
       coalesce(energy, 0) as energy_co2_mt,
       case when total > 0 then {_r('cement / nullif(total, 0) * 100', 2)} end as cement_co2_share_pct
from (select year, country, co2_total_mt as total, co2_per_capita as per_capita,
             cement_co2 as cement, energy_co2 as energy
      from raw_owid) o
where year is not null and country is not null and total > 0
"""

BENCH_METRICS = """
select cast(year as integer) as year, s.sector, country as region, metric, value, 'unit' as unit
from (
  select year, country, 'co2_intensity' as metric, co2_total_mt as value from owid_fixture
  union all
  select year, country, 'heat_consumption', energy_co2 from owid_fixture
  union all
  select year, country, 'per_capita', co2_per_capita from owid_fixture
) m, (values ('cement'), ('steel')) s(sector)
"""

STG_IEA_DERIVED = f"""
select year, sector, region,
       max(case when metric = 'co2_intensity' then value end) as co2_intensity_kg_per_t,
       max(case when metric = 'heat_consumption' then value end) as heat_consumption_mj_per_t,
       650 as scg_target_2030, 0 as scg_target_2050, 800 as baseline_2020
from bench_metrics
where sector = 'cement'
group by year, sector, region
"""

AIR_BODIES = """
select event_id,
       concat('{"date":',
         case event_id % 5
           when 1 then concat('"', cast(cast(ts as date) as varchar), '"')
           when 2 then '"not-a-date"'
           else concat('{"utc":"', cast(cast(ts as date) as varchar), 'T00:00:00Z"}') end,
         case when event_id % 5 = 3 then ''
              else concat(',"location":"ST_', cast(user_id % 7 as varchar), '","country":"TH"') end,
         ',"parameter":"', event_type, '"',
         case when event_id % 5 = 4 then ',"value":null'
              else concat(',"value":', cast(cast(value as decimal(10,2)) as varchar)) end,
         '}') as body
from events
"""

AIR_PARSED = f"""
with f as (
  select try_strptime(substr(coalesce(json_extract_string(body, '$.date.utc'),
                                      json_extract_string(body, '$.date')), 1, 10), '%Y-%m-%d') as d,
         json_extract_string(body, '$.location') as location,
         json_extract_string(body, '$.country') as country,
         json_extract_string(body, '$.parameter') as parameter,
         json_extract_string(body, '$.value') as v,
         json_extract_string(body, '$.unit') as unit
  from air_bodies
)
select cast(d as date) as measurement_date,
       coalesce(location, 'Rayong') as location,
       coalesce(country, 'TH') as country,
       coalesce(parameter, '') as parameter,
       case when v is null or v = '' then 0e0 else try_cast(v as double) end as value,
       coalesce(unit, 'µg/m³') as unit
from f
where d is not null and (v is null or v = '' or try_cast(v as double) is not null)
"""

PIPELINE_LOG = """
select event_id as id, ts as run_at,
       case when event_type in ('click', 'view') then 'ingest_sensor_readings' else 'transform' end as dag_id,
       event_type as source, cast(floor(value) as int) as rows_loaded,
       case when event_type = 'error' then 'warning' else 'success' end as status,
       props as message
from events
"""

_CTES = {
    "raw_sensor": RAW_SENSOR,
    "stg_sensor": STG_SENSOR,
    "plant_days": PLANT_DAYS,
    "scope1": SCOPE1,
    "scope2": SCOPE2,
    "scope3": SCOPE3,
    "mart_co2": MART_CO2,
    "mart_joined": MART_JOINED,
    "raw_iea": RAW_IEA,
    "net_zero": NET_ZERO,
    "bgap": BENCHMARK_GAP,
    "owid_fixture": OWID_FIXTURE,
    "raw_owid": RAW_OWID,
    "stg_owid": STG_OWID,
    "bench_metrics": BENCH_METRICS,
    "stg_iea_derived": STG_IEA_DERIVED,
    "air_bodies": AIR_BODIES,
    "air_parsed": AIR_PARSED,
    "pipeline_log": PIPELINE_LOG,
}
_DEPS = {
    "stg_sensor": ["raw_sensor"],
    "plant_days": ["stg_sensor"],
    "scope1": ["plant_days"],
    "scope2": ["plant_days"],
    "scope3": ["plant_days"],
    "mart_co2": ["scope1", "plant_days"],
    "mart_joined": ["scope1", "plant_days"],
    "net_zero": ["mart_co2"],
    "bgap": ["mart_co2", "raw_iea"],
    "raw_owid": ["owid_fixture"],
    "stg_owid": ["raw_owid"],
    "air_parsed": ["air_bodies"],
    "bench_metrics": ["owid_fixture"],
    "stg_iea_derived": ["bench_metrics"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for dep in _DEPS.get(n, []):
            visit(dep)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def _with(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} as (\n{_CTES[n].strip()}\n)" for n in _closure(names))
    return f"with {ctes}\n{body.strip()}"


_TESTED = (("raw_sensor_readings", "raw_sensor", ("reading_date", "plant_id", "sensor", "value")),
           ("raw_owid_emissions", "raw_owid", ("year", "country")),
           ("raw_iea_benchmarks", "raw_iea", ("year", "sector", "metric")),
           ("stg_sensor_readings", "stg_sensor", ("reading_date", "plant_id", "sensor")),
           ("mart_co2_intensity", "mart_co2", ("reading_date", "scope1_kg_per_t")))


def _not_null_sql(prefix: str = "") -> str:
    return "\nunion all\n".join(
        f"select 'not_null_{table}_{c}' as test_name, '{table}' as table_name, '{c}' as column_name, "
        f"count(*) - count({c}) as failures from {prefix}{name}"
        for table, name, columns in _TESTED for c in columns)


def _test_results_sql() -> str:
    singular = "\nunion all\n".join(
        f"select '{test}', 'mart_co2_intensity', 'scope1_kg_per_t', count(*) filter ({bad}) from mart_co2"
        for test, bad in (("co2_not_negative", "scope1_kg_per_t < 0"),
                          ("intensity_reasonable_range", "scope1_kg_per_t not between 200 and 1200")))
    return f"{_not_null_sql()}\nunion all\n{singular}"


# The tables with missing values that the NOT NULL tests are shown.
_FAULTY = """
, f_raw_sensor as (
  select case when day(reading_date) <> 6 then reading_date end as reading_date,
         case when day(reading_date) <> 3 then plant_id end as plant_id,
         case when day(reading_date) <> 4 then sensor end as sensor,
         case when day(reading_date) <> 5 then value end as value from raw_sensor),
f_stg_sensor as (select * from f_raw_sensor where value > 0 and sensor is not null),
f_raw_owid as (
  select case when country <> 'CHINA' or year = 2010 then year end as year,
         case when year <> 2010 then country end as country from raw_owid),
f_raw_iea as (
  select year, case when year <> 2010 then sector end as sector,
         case when year <> 2011 then metric end as metric from bench_metrics),
f_mart_co2 as (
  select reading_date, case when reading_count <> 1 then scope1_kg_per_t end as scope1_kg_per_t from mart_co2)
"""


_ALL_NN = ["raw_sensor", "raw_owid", "raw_iea", "stg_sensor", "mart_co2"]

_MART_COLS = ("reading_date, plant_id, scope1_kg_per_t, scope1_7d_avg, scope1_30d_avg, scope2_kg_per_t, "
              "scope3_kg_per_t, total_co2_kg_per_t, reading_count, anomaly_count, exceeds_2030_target")


def _latest(src: str, cols: str) -> str:
    return (f"select {cols} from (select *, row_number() over (partition by plant_id "
            f"order by reading_date desc) as rn from {src}) where rn = 1")


def _window(src: str, cols: str, days: int = 90) -> str:
    return f"select {cols} from {src} where reading_date >= {AS_OF} - {days}"


_SCOPE1_COLS = ("reading_date, plant_id, scope1_intensity_avg, scope1_intensity_min, scope1_intensity_max, "
                "scope1_intensity_std, heat_consumption_avg, coal_total_t_day, reading_count, anomaly_count")

_LABEL_CASES = ("when 'top_10pct' then '🥇 Top 10%' when 'above_average' then '⬆️ Above average' "
                "when 'below_average' then '⬇️ Below average' when 'bottom_10pct' then '⚠️ Bottom 10%'")
_BAR_UNION = "\n        union all\n        ".join(
    f"select plant_id, reading_date, '{cat}' as category, {col} as value, position_label, "
    f"coalesce(gap_vs_global, 0e0) as gap_vs_global, coalesce(gap_vs_asean, 0e0) as gap_vs_asean from labelled"
    for cat, col in (("SCG (current)", "scg_intensity"), ("ASEAN avg", "asean_avg"),
                     ("Global avg", "global_avg"), ("SCG 2030 target", "scg_2030_target")))

ORACLE: dict[str, str] = {
    "scan_sensor": _with(["raw_sensor"], "select reading_date, plant_id, sensor, value, unit_label, is_anomaly from raw_sensor"),
    "flag_anomaly": _with(["raw_sensor"], "select reading_date, plant_id, sensor, value, unit_label, is_anomaly from raw_sensor"),
    "load_replace_day": _with(["raw_sensor"], """
        , last_day as (select max(reading_date) as d from raw_sensor where plant_id = 'PLANT_01')
        select reading_date, plant_id, sensor,
               case when plant_id = 'PLANT_01' and reading_date = (select d from last_day)
                    then value * 1.01e0 else value end as value,
               unit_label, is_anomaly
        from raw_sensor"""),
    "stream_ingest_sensor": None,
    "ingest_owid": _with(["raw_owid"], "select year, country, co2_per_capita, co2_total_mt, cement_co2, energy_co2 from raw_owid"),
    "ingest_openaq": _with(["air_parsed"], "select * from air_parsed"),
    "audit_summary": _with(["pipeline_log"], """
        select dag_id, source, status, count(*) as runs, cast(sum(rows_loaded) as bigint) as rows_loaded,
               max(run_at) as last_run_at
        from pipeline_log group by dag_id, source, status"""),
    "stg_sensor": _with(["stg_sensor"], "select * exclude (ingested_at) from stg_sensor"),
    "stg_owid": _with(["stg_owid"], "select * from stg_owid"),
    "stg_iea": _with(["stg_iea_derived"], "select * from stg_iea_derived"),
    "scope1_daily": _with(["scope1"], f"select {_SCOPE1_COLS}, exceeds_2030_target from scope1"),
    "scope1_rolling": _with(["scope1"], "select reading_date, plant_id, scope1_intensity_avg, scope1_rolling_7d, scope1_rolling_30d from scope1"),
    "scope1_mom": _with(["scope1"], "select reading_date, plant_id, scope1_intensity_avg, scope1_mom_change from scope1"),
    "scope1_emissions": _with(["scope1"], f"""
        select {_SCOPE1_COLS}, scope1_rolling_7d, scope1_rolling_30d, scope1_mom_change, exceeds_2030_target
        from scope1"""),
    "o2_daily": _with(["scope2"], "select reading_date, plant_id, o2_avg, reading_count from scope2"),
    "scope2": _with(["scope2"], "select reading_date, plant_id, scope2_intensity_kg_per_t, grid_emission_factor_kg_per_kwh, reading_count from scope2"),
    "scope3": _with(["scope3"], "select * from scope3"),
    "co2_intensity": _with(["mart_co2"], "select * from mart_co2"),
    "co2_intensity_joined": _with(["mart_joined"], "select * from mart_joined"),
    "load_defaults": _with(["raw_sensor"], """
        select * replace (sensor <> 'O2_flue_gas' and is_anomaly as is_anomaly,
                          timestamp '2001-11-05 00:00:00' as ingested_at) from raw_sensor"""),
    "ingest_openaq_recent": _with(["air_parsed"], """
        select * from air_parsed where parameter in ('click', 'purchase')
        and measurement_date >= date '2024-01-21'"""),
    "run_log": _with(["raw_sensor", "raw_owid", "air_parsed", "stg_sensor", "mart_co2"], """
        select 'ingest_sensor_readings' as dag_id, 'kiln_feed' as source,
               cast(count(*) as integer) as rows_loaded, 'success' as status from raw_sensor
        union all select 'ingest_external_sources', 'owid_co2', count(*), 'success' from raw_owid
        union all select 'ingest_external_sources', 'iea_benchmarks', 9, 'success'
        union all select 'ingest_external_sources', 'openaq', count(*), 'success' from air_parsed
        union all select 'transform', 'data_tests', 16 - max(bad), case when max(bad) > 0 then 'warning' else 'success' end
        from (select cast(count(*) > 0 as integer) as bad from mart_co2 where scope1_kg_per_t not between 200 and 1200) t
        union all select 'transform', 'parquet_export', 3, 'success'"""),
    "net_zero": _with(["net_zero"], "select * from net_zero"),
    "status_distribution": _with(["net_zero"], "select status_2030, count(*) as plant_days from net_zero group by status_2030"),
    "benchmark_gap": _with(["bgap"], "select * from bgap"),
    "dq_not_null": _with(["raw_sensor", "raw_owid", "bench_metrics", "mart_co2"], f"""{_FAULTY}
        select *, case when failures > 0 then 'fail' else 'pass' end as status
        from ({_not_null_sql("f_")}) t"""),
    "dq_not_negative": _with(["mart_co2"], """
        select reading_date, plant_id, scope1_kg_per_t - 700e0 as scope1_kg_per_t
        from mart_co2 where scope1_kg_per_t < 700"""),
    "dq_range": _with(["mart_co2"], """
        select reading_date, plant_id, scope1_kg_per_t, 'out_of_reasonable_range' as issue
        from mart_co2 where scope1_kg_per_t < 200 or scope1_kg_per_t > 1200"""),
    "dq_freshness": _with(["raw_sensor"], f"""
        select 'raw_sensor_readings' as source, max_loaded_at,
               date_diff('second', max_loaded_at, {RUN_TS}) / 3600.0e0 as age_hours,
               case when max_loaded_at is null or date_diff('second', max_loaded_at, {RUN_TS}) > 5 * 86400 then 'error'
                    when date_diff('second', max_loaded_at, {RUN_TS}) > 2 * 86400 then 'warn'
                    else 'pass' end as status
        from (select max(ingested_at) as max_loaded_at from raw_sensor) m"""),
    "dq_results": _with(_ALL_NN, f"""
        select *, case when failures > 0 then 'fail' else 'pass' end as status
        from ({_test_results_sql()}) t"""),
    "dq_summary": _with(_ALL_NN, f"""
        select status, count(*) as tests from (
          select case when failures > 0 then 'fail' else 'pass' end as status
          from ({_test_results_sql()}) t) s
        group by status"""),
    "rpt_latest": _with(["mart_co2"], _latest("mart_co2", _MART_COLS)),
    "rpt_trend": _with(["mart_co2"], _window("mart_co2", "reading_date, plant_id, scope1_kg_per_t, scope1_7d_avg, scope1_30d_avg, total_co2_kg_per_t")),
    "rpt_progress": _with(["net_zero"], _window("net_zero", "reading_date, plant_id, current_intensity, target_2030, target_2050, progress_pct_to_2030, progress_pct_to_2050, gap_vs_2030_target, status_2030, required_annual_reduction")),
    "rpt_benchmark": _with(["bgap"], _window("bgap", "reading_date, plant_id, scg_intensity, global_avg, asean_avg, scg_2030_target, gap_vs_global, gap_vs_asean, industry_position")),
    "rpt_scope_breakdown": _with(["mart_co2"], _window("mart_co2", "reading_date, plant_id, scope1_kg_per_t, scope2_kg_per_t, scope3_kg_per_t, total_co2_kg_per_t")),
    "rpt_pipeline_log": _with(["pipeline_log"], """
        select timezone('Asia/Bangkok', timezone('UTC', run_at)) as run_at, dag_id, source, rows_loaded, status, message
        from pipeline_log
        order by run_at desc, dag_id, source, status, rows_loaded, message
        limit 20"""),
    "rpt_kpi": _with(["mart_co2"], f"""
        select plant_id, reading_date,
               coalesce(scope1_kg_per_t, 0e0) as current_intensity,
               coalesce(scope1_30d_avg, coalesce(scope1_kg_per_t, 0e0)) as rolling_30d_or_current,
               coalesce(total_co2_kg_per_t, 0e0) as total_co2,
               cast(coalesce(anomaly_count, 0) as bigint) as anomalies,
               coalesce(scope1_kg_per_t, 0e0) - 650e0 as gap_vs_2030_target,
               greatest(0e0, (800e0 - coalesce(scope1_kg_per_t, 0e0)) / 150e0 * 100e0) as progress_pct_to_2030,
               case when coalesce(scope1_kg_per_t, 0e0) > 682.5e0 then 'red'
                    when coalesce(scope1_kg_per_t, 0e0) > 650e0 then 'orange' else 'green' end as gauge_band,
               case when coalesce(scope1_kg_per_t, 0e0) <= 650e0 then 'on_track' else 'off_track' end as status_2030
        from ({_latest("mart_co2", "*")}) l"""),
    "rpt_scope_share": _with(["mart_co2"], f"""
        , l as ({_latest("mart_co2", "plant_id, reading_date, coalesce(scope1_kg_per_t, 0e0) as s1, coalesce(scope2_kg_per_t, 0e0) as s2, coalesce(scope3_kg_per_t, 0e0) as s3")})
        select plant_id, reading_date, 'Scope 1' as scope, s1 as kg_per_t, {_r('s1 / nullif(s1 + s2 + s3, 0) * 100', 2)} as share_pct from l
        union all
        select plant_id, reading_date, 'Scope 2', s2, {_r('s2 / nullif(s1 + s2 + s3, 0) * 100', 2)} from l
        union all
        select plant_id, reading_date, 'Scope 3', s3, {_r('s3 / nullif(s1 + s2 + s3, 0) * 100', 2)} from l"""),
    "rpt_benchmark_latest": _with(["bgap"], f"""
        , l as ({_latest('(' + _window('bgap', '*') + ')', '*')})
        , labelled as (
          select *, coalesce(case industry_position {_LABEL_CASES} end, industry_position) as position_label
          from l)
        {_BAR_UNION}"""),
    "export_co2_intensity": _with(["mart_co2"], "select * from mart_co2"),
    "export_net_zero": _with(["net_zero"], "select * from net_zero"),
    "export_benchmark_gap": _with(["bgap"], "select * from bgap"),
}
ORACLE["stream_ingest_sensor"] = ORACLE["load_replace_day"]
ORACLE["stream_ingest_air_quality"] = ORACLE["ingest_openaq"]
ORACLE["ingest_openaq_documents"] = ORACLE["ingest_openaq"]
for _name in ("rpt_kpi", "rpt_benchmark"):
    ORACLE[f"run_{_name}"] = ORACLE[_name]
ORACLE["run_test_results"] = ORACLE["dq_results"]

# Calendar dates are emitted as midnight timestamps, as the Spark queries do (``as_compared``).
_DATE_COLUMNS = {name: ["measurement_date"] for name in (
    "ingest_openaq", "stream_ingest_air_quality", "ingest_openaq_documents", "ingest_openaq_recent")}
_NO_DATES = {"audit_summary", "ingest_owid", "stg_owid", "stg_iea", "status_distribution", "dq_not_null",
             "dq_results", "dq_summary", "dq_freshness", "rpt_pipeline_log", "run_test_results", "run_log"}
for _name, _sql in list(ORACLE.items()):
    if _name in _NO_DATES:
        continue
    _cols = _DATE_COLUMNS.get(_name, ["reading_date"])
    _replace = ", ".join(f"cast({c} as timestamp) as {c}" for c in _cols)
    ORACLE[_name] = f"select * replace ({_replace}) from (\n{_sql}\n) q"
