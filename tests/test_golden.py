"""Golden rows worked by hand from the model formulas (one plant, one typical day)."""

import datetime as dt

import pytest

from cinderframe.operators import ingest, marts, scopes, staging
from conftest import readings

DAY = dt.date(2024, 3, 1)
RUN_TS = dt.datetime(2024, 3, 2, 0, 0)


@pytest.fixture(scope="module")
def day_rows(spark):
    raw = readings(spark, [
        (DAY, "P1", "CO2_emission_intensity", 680.0),
        (DAY, "P1", "specific_heat_consumption", 750.0),
        (DAY, "P1", "coal_consumption_rate", 10.2),
        (DAY, "P1", "O2_flue_gas", 2.5),
    ])
    stg = staging.stg_sensor_readings(raw)
    daily = scopes.daily_plant_readings(stg)
    s1 = scopes.scope1_emissions(daily)
    s2 = scopes.scope2_emissions(daily)
    s3 = scopes.scope3_emissions(s1)
    co2 = marts.co2_intensity(s1, RUN_TS)
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=RUN_TS))
    return {
        "stg": {r["sensor"]: r for r in stg.collect()},
        "s1": s1.collect()[0], "s2": s2.collect()[0], "s3": s3.collect()[0],
        "co2": co2.collect()[0],
        "nz": marts.net_zero_progress(co2).collect()[0],
        "bg": marts.benchmark_gap(co2, iea).collect()[0],
    }


def test_unit_conversions(day_rows):
    stg = day_rows["stg"]
    assert stg["specific_heat_consumption"]["co2_kg_per_t"] == pytest.approx(67.4025)
    assert stg["specific_heat_consumption"]["heat_mj_per_t"] == pytest.approx(3.138)
    assert stg["coal_consumption_rate"]["coal_t_per_day"] == pytest.approx(244.8)
    assert stg["CO2_emission_intensity"]["co2_kg_per_t"] == 680.0
    assert stg["O2_flue_gas"]["co2_kg_per_t"] is None


def test_scope1(day_rows):
    s1 = day_rows["s1"]
    assert s1["scope1_intensity_avg"] == pytest.approx(373.70125)
    assert s1["scope1_intensity_min"] == pytest.approx(67.4025)
    assert s1["scope1_intensity_max"] == 680.0
    assert s1["scope1_intensity_std"] == pytest.approx(612.5975 / 2 ** 0.5)
    assert s1["heat_consumption_avg"] == pytest.approx(3.138)
    assert s1["coal_total_t_day"] is None  # coal rows carry no CO2 value
    assert (s1["reading_count"], s1["anomaly_count"]) == (2, 0)
    assert s1["scope1_rolling_7d"] == pytest.approx(373.70125)
    assert s1["scope1_rolling_30d"] == pytest.approx(373.70125)
    assert s1["scope1_mom_change"] is None
    assert s1["exceeds_2030_target"] is False


def test_scope2_scope3(day_rows):
    assert day_rows["s2"]["reading_count"] == 4
    assert day_rows["s2"]["scope2_intensity_kg_per_t"] == pytest.approx(54.989)
    assert day_rows["s3"]["scope3_total_kg_per_t"] == 40.0
    assert day_rows["s3"]["data_source"] == "industry_estimate"


def test_co2_mart(day_rows):
    c = day_rows["co2"]
    assert (c["scope1_kg_per_t"], c["scope2_kg_per_t"], c["scope3_kg_per_t"]) == (373.70, 54.99, 40.00)
    assert c["total_co2_kg_per_t"] == 468.69
    assert c["updated_at"] == RUN_TS


def test_net_zero(day_rows):
    n = day_rows["nz"]
    assert n["gap_vs_2030_target"] == -276.30
    assert n["gap_vs_2050_target"] == 373.70
    assert n["progress_pct_to_2030"] == 284.2
    assert n["progress_pct_to_2050"] == 53.3
    assert n["status_2030"] == "on_track"
    assert n["required_annual_reduction"] == 14.37
    assert (n["baseline_2020"], n["target_2030"], n["target_2050"]) == (800, 650, 0)


def test_benchmark_gap(day_rows):
    b = day_rows["bg"]
    assert (b["gap_vs_global"], b["gap_vs_asean"], b["gap_vs_scg_target"]) == (-246.30, -306.30, -276.30)
    assert b["global_status"] == "better_than_global"
    assert b["industry_position"] == "top_10pct"
    assert (b["global_avg"], b["asean_avg"], b["scg_2030_target"]) == (620.0, 680.0, 650.0)
