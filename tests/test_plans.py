"""Plan-shape regression tests: the scale properties the design relies on."""

import re

import pytest

from cinderframe import schemas
from cinderframe.operators import quality, scopes, sinks, staging
from cinderframe.plans import pipeline
from cinderframe.plans.queries import QUERIES, RUN_TS
from cinderframe.sources import fixtures, readers

SF = "/root/testdata/sf0.001"
WRITING = {"load_replace_day", "load_defaults", "stream_ingest_sensor", "stream_ingest_air_quality",
           "ingest_owid", "ingest_openaq", "ingest_openaq_documents", "run_rpt_kpi", "run_rpt_benchmark",
           "run_test_results", "run_log", "export_co2_intensity", "export_net_zero", "export_benchmark_gap"}


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(text: str) -> int:
    head = text.split("\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)Exchange \(", head))


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k not in WRITING))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for op in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
               "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in text, f"{name}: {op}"


def test_co2_mart_two_shuffles_no_sort_merge_join(spark):
    text = plan(QUERIES["co2_intensity"](spark, SF))
    assert shuffles(text) == 2  # partial aggregates by plant-day, then plant-day rows by plant
    assert "SortMergeJoin" not in text
    assert "partial_avg" in text  # map-side combine before the shuffle


def test_benchmark_values_are_a_subquery(spark):
    text = plan(QUERIES["benchmark_gap"](spark, SF))
    main = text.split("===== Subqueries =====")[0]
    assert "Subquery" in text
    # only the fixture's 7-row sensor spec is joined; the unused rolling windows are pruned
    assert main.split("\n\n")[0].count("BroadcastHashJoin") == 1 and shuffles(main) == 1


def test_latest_is_partial_aggregate(spark):
    text = plan(QUERIES["rpt_latest"](spark, SF))
    assert "partial_max_by" in text and "Window" in text  # the window is the mart's own
    # the per-plant aggregate reuses the window's partitioning by plant_id: no third shuffle
    assert shuffles(text) == 2


def test_stored_raw_scan_pushdown(spark, tmp_table):
    wh = pipeline.Warehouse(tmp_table("wh"))
    small = fixtures.unflagged_sensor_readings(spark, SF).limit(500)
    pipeline.ingest_sensor_batch(spark, wh, small, RUN_TS)
    raw = readers.read_sensor_readings(spark, wh.path("raw_sensor_readings"))
    text = plan(scopes.daily_plant_readings(staging.stg_sensor_readings(raw)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThan(value,0.0)" in pushed and "In(sensor" in pushed
    schema = re.search(r"ReadSchema: (struct<.*>)", text).group(1)
    assert "unit_label" not in schema and "ingested_at" not in schema  # pruned columns
    assert shuffles(text) == 1
    # Scope 1 alone reads its two sensors
    text = plan(scopes.daily_plant_readings(scopes.co2_bearing(staging.stg_sensor_readings(raw))))
    assert "In(sensor, [CO2_emission_intensity,specific_heat_consumption])" in text
    # the tests skip row groups without NULLs
    text = plan(quality.reading_not_null_checks(raw))
    assert "IsNull(value)" in re.search(r"PushedFilters: \[(.*)\]", text).group(1)


def test_the_run_prunes_its_scan(spark, tmp_table, monkeypatch):
    """The plan that the transform itself writes the plant-day aggregate with."""
    wh = pipeline.Warehouse(tmp_table("wh"))
    pipeline.ingest_sensor_batch(spark, wh, fixtures.unflagged_sensor_readings(spark, SF).limit(300), RUN_TS)
    pipeline.ingest_benchmarks(spark, wh, RUN_TS)
    spark.createDataFrame([], schemas.RAW_OWID_EMISSIONS).write.parquet(wh.path("raw_owid_emissions"))
    seen, write = {}, sinks.write_plant_days

    def spy(df, path, since=None):
        seen[path.rsplit("/", 1)[1]] = plan(df)
        return write(df, path, since)

    monkeypatch.setattr(sinks, "write_plant_days", spy)
    pipeline.transform(spark, wh, RUN_TS)
    text = seen["int_daily_plant_readings"]
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThan(value,0.0)" in pushed and "In(sensor" in pushed
    assert "ingested_at" not in re.search(r"ReadSchema: (struct<.*>)", text).group(1)


def test_loads_prune_to_their_directories(spark, tmp_table):
    path = tmp_table("raw")
    sinks.replace_plant_days(fixtures.sensor_readings(spark, SF).limit(300), path, RUN_TS)
    stored = sinks._stored(spark, path)
    keys = stored.where("reading_month > '1998'").select(*sinks.SENSOR_PARTITIONS).distinct()
    assert "dynamicpruning" in plan(stored.join(keys, sinks.SENSOR_PARTITIONS, "left_semi"))


def test_report_window_reaches_the_mart_scan(spark, tmp_table):
    from cinderframe.plans import serving
    wh = pipeline.Warehouse(tmp_table("wh"))
    pipeline.ingest_sensor_batch(spark, wh, fixtures.unflagged_sensor_readings(spark, SF).limit(300), RUN_TS)
    pipeline.ingest_benchmarks(spark, wh, RUN_TS)
    spark.createDataFrame([(2020, "X", 1.0, 2.0, 0.1, 0.2, RUN_TS)],
                          "year int, country string, co2_per_capita double, co2_total_mt double, "
                          "cement_co2 double, energy_co2 double, ingested_at timestamp") \
        .write.parquet(wh.path("raw_owid_emissions"))
    pipeline.transform(spark, wh, RUN_TS)
    text = plan(serving.report(spark, wh, "trend", fixtures.AS_OF, 90))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(reading_date" in pushed  # row groups outside the window are skipped


def test_incremental_scan_prunes_month_directories(spark, tmp_table):
    import datetime as dt
    wh = pipeline.Warehouse(tmp_table("wh"))
    pipeline.ingest_sensor_batch(spark, wh, fixtures.unflagged_sensor_readings(spark, SF).limit(300), RUN_TS)
    raw = readers.read_sensor_readings(spark, wh.path("raw_sensor_readings"), since=dt.date(1998, 1, 5))
    text = plan(scopes.daily_plant_readings(staging.stg_sensor_readings(raw)))
    assert "1998-01" in re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(reading_date,1998-01-05)" in text
