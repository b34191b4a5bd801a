"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query derives its inputs from the driver's tables (``sources.fixtures``) and runs the
library's operators over the whole tables.  Load-time columns (``ingested_at``,
``updated_at``) are left out of the outputs: they carry the run's clock, not data.
Queries that exercise a sink write to a fresh location under ``spark.checkpoint.dir`` and
return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from ..operators import ingest, marts, quality, reports, scopes, sinks, staging
from ..session import scratch_path
from ..sources import fixtures, readers
from ..streaming import air_quality_stream, sensor_stream
from . import pipeline, serving

AS_OF = fixtures.AS_OF
RUN_TS = fixtures.RUN_TS
KEYS = ["reading_date", "plant_id"]
REPLACED_PLANT = "PLANT_01"


# --- shared building blocks ------------------------------------------------------------

def raw_sensor(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.sensor_readings(spark, d)


def stg_sensor(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_sensor_readings(raw_sensor(spark, d))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return scopes.daily_plant_readings(stg_sensor(spark, d))


def scope1(spark: SparkSession, d: str) -> DataFrame:
    bearing = scopes.co2_bearing(stg_sensor(spark, d))
    return scopes.scope1_emissions(scopes.daily_plant_readings(bearing))


def co2(spark: SparkSession, d: str) -> DataFrame:
    return marts.co2_intensity(scope1(spark, d), RUN_TS)


def raw_iea(spark: SparkSession) -> DataFrame:
    return ingest.benchmark_rows(spark, DEFAULT, RUN_TS)


def stg_iea(spark: SparkSession) -> DataFrame:
    return staging.stg_iea_benchmarks(raw_iea(spark))


def net_zero(spark: SparkSession, d: str) -> DataFrame:
    return marts.net_zero_progress(co2(spark, d))


def bgap(spark: SparkSession, d: str) -> DataFrame:
    return marts.benchmark_gap(co2(spark, d), stg_iea(spark))


def raw_owid(spark: SparkSession, d: str) -> DataFrame:
    return ingest.clean_owid(fixtures.owid_csv_frame(spark, d), run_ts=RUN_TS)


# --- queries ---------------------------------------------------------------------------

def q_scan_sensor(spark, d):
    return raw_sensor(spark, d).drop("ingested_at")


def q_flag_anomaly(spark, d):
    flagged = ingest.flag_anomalies(fixtures.unflagged_sensor_readings(spark, d))
    return flagged.drop("ingested_at")


def q_load_replace_day(spark, d):
    """Load every plant-day, then re-load the latest day of one plant with corrected
    values (x1.01); the table must hold the corrected rows and all others unchanged."""
    path = scratch_path(spark, "raw_sensor_readings")
    base = raw_sensor(spark, d)
    sinks.replace_plant_days(base, path, RUN_TS)
    plant = readers.read_sensor_readings(spark, path).where(F.col("plant_id") == REPLACED_PLANT)
    last_day = plant.agg(F.max("reading_date").alias("reading_date"))
    batch = plant.join(last_day, "reading_date").withColumn("value", F.col("value") * 1.01)
    sinks.replace_plant_days(batch.select(*base.columns), path, RUN_TS)
    return readers.read_sensor_readings(spark, path).drop("ingested_at")


def q_load_defaults(spark, d):
    """A load whose rows lack the load time and, for one sensor, the anomaly flag."""
    path = scratch_path(spark, "raw_sensor_defaults")
    raw = fixtures.faulty(raw_sensor(spark, d).drop("ingested_at"), "is_anomaly",
                          F.col("sensor") == "O2_flue_gas")
    sinks.replace_plant_days(raw, path, RUN_TS)
    return readers.read_sensor_readings(spark, path).withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp_ntz"))


def q_stream_ingest_sensor(spark, d):
    """The same two loads as ``load_replace_day``, delivered as landed files (eight for the
    first) and picked up by the ingestion stream in two scheduled runs (``availableNow``)."""
    landing = scratch_path(spark, "landing_sensor")
    table = scratch_path(spark, "raw_sensor_stream")
    ckpt = scratch_path(spark, "ckpt_sensor_stream")
    landed_cols = [f.name for f in sensor_stream.LANDED_SENSOR_SCHEMA.fields]
    (fixtures.unflagged_sensor_readings(spark, d).select(*landed_cols).repartition(8)
     .write.parquet(f"{landing}/{sensor_stream.DELIVERY}=0001"))
    sensor_stream.run_available(spark, landing, table, ckpt)
    plant = readers.read_sensor_readings(spark, table).where(F.col("plant_id") == REPLACED_PLANT)
    last_day = plant.agg(F.max("reading_date").alias("reading_date"))
    correction = plant.join(last_day, "reading_date").withColumn("value", F.col("value") * 1.01)
    correction.select(*landed_cols).write.parquet(f"{landing}/{sensor_stream.DELIVERY}=0002")
    sensor_stream.run_available(spark, landing, table, ckpt)
    return readers.read_sensor_readings(spark, table).drop("ingested_at")


def q_ingest_owid(spark, d):
    """Two landed files with their columns in different orders."""
    landed = scratch_path(spark, "owid_landed_csv")
    rows = fixtures.owid_csv_frame(spark, d)
    for odd, columns in ((0, rows.columns), (1, rows.columns[::-1])):
        (rows.where(F.col("year") % 2 == odd).select(*columns).write.mode("append")
         .option("header", True).csv(landed))
    cleaned = ingest.clean_owid(readers.read_country_csv(spark, landed), run_ts=RUN_TS)
    path = scratch_path(spark, "raw_owid_emissions")
    sinks.overwrite_table(cleaned, path)
    return readers.read_owid_emissions(spark, path).drop("ingested_at")


def _appended(spark, records: DataFrame) -> DataFrame:
    path = scratch_path(spark, "raw_openaq_readings")
    sinks.append_load(ingest.parse_air_quality(records, RUN_TS), path, "batch-1")
    return readers.read_openaq_readings(spark, path).drop("ingested_at")


def q_ingest_openaq(spark, d):
    landed = scratch_path(spark, "openaq_landed_json")
    fixtures.air_quality_bodies(spark, d).select("body").write.text(landed)
    return _appended(spark, readers.read_air_quality_records(spark, landed))


def q_ingest_openaq_documents(spark, d):
    landed = scratch_path(spark, "openaq_landed_documents")
    fixtures.air_quality_documents(spark, d).write.text(landed)
    return _appended(spark, readers.read_air_quality_documents(spark, landed))


def q_ingest_openaq_recent(spark, d):
    """The fetch's own restriction, with parameters and a date of these records."""
    parsed = ingest.parse_air_quality(fixtures.air_quality_bodies(spark, d), RUN_TS)
    recent = ingest.recent_air_quality(parsed, dt.date(2024, 1, 28), ("click", "purchase"))
    return recent.drop("ingested_at")


def q_stream_ingest_air_quality(spark, d):
    """Air-quality records landed as files, appended by the exactly-once streaming sink."""
    landing = scratch_path(spark, "landing_air_quality")
    table = scratch_path(spark, "raw_openaq_stream")
    ckpt = scratch_path(spark, "ckpt_air_quality_stream")
    fixtures.air_quality_bodies(spark, d).select("body").write.text(landing)
    air_quality_stream.run_available(spark, landing, table, ckpt)
    return readers.read_openaq_readings(spark, table).drop("ingested_at")


def q_audit_summary(spark, d):
    log = fixtures.pipeline_log(spark, d)
    return log.groupBy("dag_id", "source", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.max("run_at").cast("timestamp_ntz"))
        .alias("last_run_at"))


def q_stg_sensor(spark, d):
    return stg_sensor(spark, d).drop("ingested_at")


def q_stg_owid(spark, d):
    return staging.stg_owid_emissions(raw_owid(spark, d)).drop("ingested_at")


def q_stg_iea(spark, d):
    """The benchmark pivot (one row per year/sector/region/load) over derived metric rows."""
    return staging.stg_iea_benchmarks(fixtures.benchmark_metrics(spark, d)).drop("ingested_at")


def q_scope1_daily(spark, d):
    return scope1(spark, d).drop("scope1_rolling_7d", "scope1_rolling_30d", "scope1_mom_change")


def q_scope1_rolling(spark, d):
    return scope1(spark, d).select(*KEYS, "scope1_intensity_avg", "scope1_rolling_7d",
                                   "scope1_rolling_30d")


def q_scope1_mom(spark, d):
    return scope1(spark, d).select(*KEYS, "scope1_intensity_avg", "scope1_mom_change")


def q_scope1_emissions(spark, d):
    return scope1(spark, d)


def q_o2_daily(spark, d):
    return scopes.o2_daily(daily(spark, d))


def q_scope2(spark, d):
    return scopes.scope2_emissions(daily(spark, d))


def q_scope3(spark, d):
    return scopes.scope3_emissions(scope1(spark, d))


def q_co2_intensity(spark, d):
    return co2(spark, d).drop("updated_at")


def q_net_zero(spark, d):
    return net_zero(spark, d).drop("updated_at")


def q_status_distribution(spark, d):
    return marts.status_distribution(net_zero(spark, d))


def q_benchmark_gap(spark, d):
    return bgap(spark, d).drop("updated_at")


def q_co2_intensity_joined(spark, d):
    """The mart with a Scope 2 table that varies and lacks some plant-days."""
    s1 = scope1(spark, d)
    s2 = fixtures.metered_scope2(scopes.scope2_emissions(daily(spark, d)))
    return marts.co2_intensity_joined(s1, s2, scopes.scope3_emissions(s1), RUN_TS).drop("updated_at")


def q_dq_not_null(spark, d):
    """The NOT NULL tests over tables in which every tested column has missing values."""
    day = F.dayofmonth("reading_date")
    raw = raw_sensor(spark, d)
    raw = fixtures.faulty(raw, "plant_id", day == 3)
    raw = fixtures.faulty(raw, "sensor", day == 4)
    raw = fixtures.faulty(raw, "value", day == 5)
    raw = fixtures.faulty(raw, "reading_date", day == 6)
    owid = raw_owid(spark, d)
    owid = fixtures.faulty(fixtures.faulty(owid, "country", F.col("year") == 2010), "year",
                           F.col("country") == "CHINA")
    metrics = fixtures.benchmark_metrics(spark, d)
    metrics = fixtures.faulty(fixtures.faulty(metrics, "sector", F.col("year") == 2010), "metric",
                              F.col("year") == 2011)
    mart = fixtures.faulty(co2(spark, d), "scope1_kg_per_t", F.col("reading_count") == 1)
    others = quality.not_null_checks({"raw_owid_emissions": owid, "raw_iea_benchmarks": metrics,
                                      "mart_co2_intensity": mart})
    return quality.reading_not_null_checks(raw).unionByName(others)


def q_dq_not_negative(spark, d):
    """The singular test over intensities that are 700 too low."""
    low = co2(spark, d).withColumn("scope1_kg_per_t", F.col("scope1_kg_per_t") - 700.0)
    return quality.negative_intensity(low)


def q_dq_range(spark, d):
    return quality.out_of_range_intensity(co2(spark, d))


def q_dq_freshness(spark, d):
    f = quality.freshness(raw_sensor(spark, d), "raw_sensor_readings", RUN_TS)
    return f.withColumn("max_loaded_at", F.col("max_loaded_at").cast("timestamp_ntz"))


def _test_results(spark, d):
    return quality.check_results_from_raw(raw_sensor(spark, d), raw_owid(spark, d), raw_iea(spark),
                                         co2(spark, d))


def q_dq_results(spark, d):
    return _test_results(spark, d)


def q_dq_summary(spark, d):
    return quality.check_summary(_test_results(spark, d))


def q_rpt_latest(spark, d):
    return reports.latest_per_plant(co2(spark, d)).drop("updated_at")


def q_rpt_trend(spark, d):
    return reports.trend(co2(spark, d), AS_OF)


def q_rpt_progress(spark, d):
    return reports.progress(net_zero(spark, d), AS_OF)


def q_rpt_benchmark(spark, d):
    return reports.benchmark(bgap(spark, d), AS_OF)


def q_rpt_scope_breakdown(spark, d):
    return reports.scope_breakdown(co2(spark, d), AS_OF)


def q_rpt_pipeline_log(spark, d):
    return reports.pipeline_log_recent(fixtures.pipeline_log(spark, d))


def q_rpt_kpi(spark, d):
    return reports.kpi(co2(spark, d))


def q_rpt_scope_share(spark, d):
    return reports.scope_share(co2(spark, d))


def q_rpt_benchmark_latest(spark, d):
    return reports.benchmark_latest(bgap(spark, d), AS_OF)


_RUNS: dict[tuple[str, str], pipeline.Warehouse] = {}


def _run(spark, d) -> pipeline.Warehouse:
    """A warehouse after the loads and a full transform; one run serves a session's queries."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        wh = pipeline.Warehouse(scratch_path(spark, "warehouse"))
        pipeline.run_all(spark, d, wh.root, RUN_TS)
        _RUNS[key] = wh
    return _RUNS[key]


def q_run_rpt_kpi(spark, d):
    return serving.report(spark, _run(spark, d), "kpi", AS_OF)


def q_run_rpt_benchmark(spark, d):
    return serving.report(spark, _run(spark, d), "benchmark", AS_OF)


def q_run_test_results(spark, d):
    return spark.read.parquet(_run(spark, d).path("data_test_results"))


def q_run_log(spark, d):
    """The records that the loads and the transform left in the audit log."""
    log = readers.read_pipeline_log(spark, _run(spark, d).log)
    return log.select("dag_id", "source", "rows_loaded", "status")


def _export(spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"export_{name}")
    sinks.export_newest_first(df, path)
    return spark.read.parquet(path).drop("updated_at")


def q_export_co2_intensity(spark, d):
    return _export(spark, co2(spark, d), "mart_co2_intensity")


def q_export_net_zero(spark, d):
    return _export(spark, net_zero(spark, d), "mart_net_zero_progress")


def q_export_benchmark_gap(spark, d):
    return _export(spark, bgap(spark, d), "mart_benchmark_gap")


def as_compared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Emit DATE columns as midnight timestamps (without time zone), the type the driver's
    tables use for calendar dates, so both engines' results compare alike.  The tables the
    library writes keep DATE."""

    def wrapped(spark: SparkSession, d: str) -> DataFrame:
        df = fn(spark, d)
        dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
        if not dates:
            return df
        return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in dates else F.col(c)
                           for c in df.columns])

    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_sensor": q_scan_sensor,
    "flag_anomaly": q_flag_anomaly,
    "load_replace_day": q_load_replace_day,
    "stream_ingest_sensor": q_stream_ingest_sensor,
    "ingest_owid": q_ingest_owid,
    "load_defaults": q_load_defaults,
    "ingest_openaq": q_ingest_openaq,
    "ingest_openaq_documents": q_ingest_openaq_documents,
    "ingest_openaq_recent": q_ingest_openaq_recent,
    "stream_ingest_air_quality": q_stream_ingest_air_quality,
    "audit_summary": q_audit_summary,
    "stg_sensor": q_stg_sensor,
    "stg_owid": q_stg_owid,
    "stg_iea": q_stg_iea,
    "scope1_daily": q_scope1_daily,
    "scope1_rolling": q_scope1_rolling,
    "scope1_mom": q_scope1_mom,
    "scope1_emissions": q_scope1_emissions,
    "o2_daily": q_o2_daily,
    "scope2": q_scope2,
    "scope3": q_scope3,
    "co2_intensity": q_co2_intensity,
    "co2_intensity_joined": q_co2_intensity_joined,
    "net_zero": q_net_zero,
    "status_distribution": q_status_distribution,
    "benchmark_gap": q_benchmark_gap,
    "dq_not_null": q_dq_not_null,
    "dq_not_negative": q_dq_not_negative,
    "dq_range": q_dq_range,
    "dq_freshness": q_dq_freshness,
    "dq_results": q_dq_results,
    "dq_summary": q_dq_summary,
    "rpt_latest": q_rpt_latest,
    "rpt_trend": q_rpt_trend,
    "rpt_progress": q_rpt_progress,
    "rpt_benchmark": q_rpt_benchmark,
    "rpt_scope_breakdown": q_rpt_scope_breakdown,
    "rpt_pipeline_log": q_rpt_pipeline_log,
    "rpt_kpi": q_rpt_kpi,
    "rpt_scope_share": q_rpt_scope_share,
    "rpt_benchmark_latest": q_rpt_benchmark_latest,
    "run_rpt_kpi": q_run_rpt_kpi,
    "run_rpt_benchmark": q_run_rpt_benchmark,
    "run_test_results": q_run_test_results,
    "run_log": q_run_log,
    "export_co2_intensity": q_export_co2_intensity,
    "export_net_zero": q_export_net_zero,
    "export_benchmark_gap": q_export_benchmark_gap,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: as_compared(fn) for name, fn in _QUERIES.items()}
