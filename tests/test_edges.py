"""Boundary cases of the classifications, rounding and windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinderframe.functions import round_half_up
from cinderframe.operators import ingest, marts, scopes, staging
from conftest import readings

RUN_TS = dt.datetime(2024, 1, 1)


def _mart(spark, values, day=dt.date(2024, 3, 1)):
    rows = [(day, f"P{i}", v, RUN_TS) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "reading_date date, plant_id string, scope1_kg_per_t double, "
                                       "updated_at timestamp")


def test_status_boundaries(spark):
    vals = [650.00, 650.01, 682.50, 682.51, None]
    out = {r["current_intensity"]: r["status_2030"]
           for r in marts.net_zero_progress(_mart(spark, vals)).collect()}
    assert out == {650.0: "on_track", 650.01: "near_target", 682.5: "near_target",
                   682.51: "off_track", None: "off_track"}


def test_position_boundaries(spark):
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=RUN_TS))
    vals = [557.99, 558.00, 619.99, 620.00, 681.99, 682.00]
    out = {r["scg_intensity"]: (r["industry_position"], r["global_status"])
           for r in marts.benchmark_gap(_mart(spark, vals), iea).collect()}
    assert out[557.99][0] == "top_10pct"
    assert out[558.0][0] == "above_average"
    assert out[619.99] == ("above_average", "better_than_global")
    assert out[620.0] == ("below_average", "worse_than_global")
    assert out[681.99][0] == "below_average"
    assert out[682.0][0] == "bottom_10pct"


def test_progress_exact_decimal_tie_and_floor(spark):
    rows = {r["current_intensity"]: r for r in
            marts.net_zero_progress(_mart(spark, [799.60, 850.0, None])).collect()}
    assert rows[799.6]["progress_pct_to_2050"] == 0.1  # a double would give 0.0
    assert rows[850.0]["progress_pct_to_2030"] == 0.0  # floored, not negative
    assert rows[None]["progress_pct_to_2030"] == 0.0   # GREATEST skips NULL
    assert rows[None]["gap_vs_2030_target"] is None


def test_progress_not_capped(spark):
    r = marts.net_zero_progress(_mart(spark, [100.0])).collect()[0]
    assert r["progress_pct_to_2030"] == 466.7


def test_required_reduction_year_2050_is_null(spark):
    df = _mart(spark, [300.0], day=dt.date(2050, 6, 1)).unionByName(
        _mart(spark, [300.0], day=dt.date(2051, 6, 1)))
    out = {r["reading_date"].year: r["required_annual_reduction"]
           for r in marts.net_zero_progress(df).collect()}
    assert out == {2050: None, 2051: -300.0}


def test_round_half_up(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (0.125,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got == [1.01, -1.01, 2.68, 0.13]


def test_rolling_windows_are_row_based_per_plant(spark):
    base = dt.date(2024, 1, 1)
    rows = []
    for i in range(40):  # every other calendar day: rows, not days, define the frame
        d = base + dt.timedelta(days=2 * i)
        rows.append((d, "A", "CO2_emission_intensity", float(100 + i)))
        rows.append((d, "B", "CO2_emission_intensity", 500.0))
    s1 = scopes.scope1_emissions(scopes.daily_plant_readings(
        staging.stg_sensor_readings(readings(spark, rows))))
    a = s1.where(F.col("plant_id") == "A").orderBy("reading_date").collect()
    assert a[0]["scope1_rolling_7d"] == 100.0
    assert a[2]["scope1_rolling_7d"] == pytest.approx(101.0)       # partial frame
    assert a[10]["scope1_rolling_7d"] == pytest.approx(sum(range(104, 111)) / 7)
    assert a[35]["scope1_rolling_30d"] == pytest.approx(sum(range(106, 136)) / 30)
    assert all(r["scope1_mom_change"] is None for r in a[:30])
    assert a[30]["scope1_mom_change"] == pytest.approx(30.0)
    b = s1.where(F.col("plant_id") == "B").collect()
    assert {r["scope1_rolling_30d"] for r in b} == {500.0}


def test_staging_filters_and_counts(spark):
    d = dt.date(2024, 1, 2)
    raw = readings(spark, [
        (d, "P", "CO2_emission_intensity", 700.0, True),
        (d, "P", "CO2_emission_intensity", -1.0),        # not positive: dropped
        (d, "P", "unknown_sensor", 5.0),                  # not whitelisted: dropped
        (d, "P", "NOx_emission", 300.0, True),            # anomaly, but not CO2-bearing
        (d, "P", "specific_heat_consumption", 700.0, None),
    ])
    daily = scopes.daily_plant_readings(staging.stg_sensor_readings(raw)).collect()[0]
    assert daily["reading_count"] == 2          # CO2-bearing rows only
    assert daily["anomaly_count"] == 1          # NULL flag is not counted
    assert daily["all_reading_count"] == 3      # Scope 2 counts every staged row


def test_single_reading_std_is_null(spark):
    raw = readings(spark, [(dt.date(2024, 1, 2), "P", "CO2_emission_intensity", 700.0)])
    s1 = scopes.scope1_emissions(scopes.daily_plant_readings(staging.stg_sensor_readings(raw)))
    assert s1.collect()[0]["scope1_intensity_std"] is None


def test_benchmark_gap_missing_benchmark_gives_no_rows(spark):
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=RUN_TS))
    no_asean = iea.where(F.col("region") != "ASEAN")
    assert marts.benchmark_gap(_mart(spark, [600.0]), no_asean).count() == 0


def test_fused_mart_equals_joined_mart(spark):
    from cinderframe.plans.queries import daily, scope1
    d = "/root/testdata/sf0.001"
    s1 = scope1(spark, d)
    fused = marts.co2_intensity(s1, RUN_TS)
    joined = marts.co2_intensity_joined(s1, scopes.scope2_emissions(daily(spark, d)),
                                        scopes.scope3_emissions(s1), RUN_TS)
    assert fused.count() == joined.count() > 0
    assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0


def test_benchmark_gap_has_a_row_per_benchmark_load(spark):
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=RUN_TS))
    again = iea.where(F.col("region") == "Global").withColumn("co2_intensity_kg_per_t", F.lit(500.0))
    rows = marts.benchmark_gap(_mart(spark, [600.0]), iea.unionByName(again)).collect()
    assert sorted((r["global_avg"], r["asean_avg"]) for r in rows) == [(500.0, 680.0), (620.0, 680.0)]


def test_empty_readings_flow_through(spark):
    from cinderframe import schemas
    from cinderframe.operators import quality, reports
    raw = spark.createDataFrame([], schemas.RAW_SENSOR_READINGS)
    stg = staging.stg_sensor_readings(raw)
    daily = scopes.daily_plant_readings(stg)
    s1 = scopes.scope1_emissions(daily)
    co2 = marts.co2_intensity(s1, RUN_TS)
    iea = staging.stg_iea_benchmarks(ingest.benchmark_rows(spark, run_ts=RUN_TS))
    for df in (stg, daily, s1, scopes.scope2_emissions(daily), scopes.scope3_emissions(s1), co2,
               marts.net_zero_progress(co2), marts.benchmark_gap(co2, iea),
               reports.kpi(co2), reports.scope_share(co2), reports.trend(co2, dt.date(2024, 1, 1))):
        assert df.count() == 0
    checks = {r["test_name"]: r["status"] for r in quality.check_results_from_raw(
        raw, raw.select(F.lit(1).alias("year"), F.lit("x").alias("country")).limit(0), iea.select(
            "year", "sector", F.lit("m").alias("metric")), co2).collect()}
    assert len(checks) == 16 and set(checks.values()) == {"pass"}
    assert quality.freshness(raw, "raw_sensor_readings", RUN_TS).first()["status"] == "error"


def test_hot_plant_day_third_of_rows(spark, tmp_path):
    """One plant-day carries a third of all readings: loads, aggregates and windows stay exact."""
    from cinderframe.operators import sinks
    from cinderframe.sources import readers
    base = dt.date(2024, 1, 1)
    normal = [(base + dt.timedelta(days=k % 20), f"P{(k // 20) % 5}", "CO2_emission_intensity", 600.0 + k % 7)
              for k in range(4000)]
    hot = [(base, "HOT", "CO2_emission_intensity", 700.0 + (k % 3)) for k in range(2000)]
    path = str(tmp_path / "raw")
    df = readings(spark, normal + hot).repartition(16)
    assert sinks.replace_plant_days(df, path, RUN_TS) == 6000
    raw = readers.read_sensor_readings(spark, path)
    daily = scopes.daily_plant_readings(staging.stg_sensor_readings(raw))
    row = daily.where((F.col("plant_id") == "HOT")).first()
    assert row["reading_count"] == 2000
    assert row["scope1_intensity_avg"] == pytest.approx(sum(700.0 + (k % 3) for k in range(2000)) / 2000)
    s1 = scopes.scope1_emissions(daily)
    assert s1.count() == 20 * 5 + 1
