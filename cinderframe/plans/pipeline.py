"""End-to-end runs: ingestion of landed sources, then staging -> scopes -> marts -> checks
-> export, each step a Spark job writing Parquet tables under one warehouse folder.

Materialized steps follow the original layering (views for staging, tables for the
intermediate and mart layers).  The readings are aggregated once per run: the fused plant-day
aggregate is written first and every scope table is derived from it.  The tests and the freshness
check read the raw table on their own, so the aggregate's scan keeps its pushed filters.  Each
written table cuts the lineage, so a lost executor re-runs only the current step.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..operators import changes, ingest, marts, quality, scopes, sinks, staging
from .. import schemas
from ..sources import fixtures, readers


@dataclass
class Warehouse:
    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    @property
    def log(self) -> str:
        return self.path("pipeline_log")


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    exported: list[str] = field(default_factory=list)
    export_failures: list[str] = field(default_factory=list)


# --- ingestion (the scheduled loads) ---------------------------------------------------

def _checked(df: DataFrame, table: str) -> DataFrame:
    """The table's NOT NULL columns enforced inside the write (see ``sinks.require_not_null``)."""
    return sinks.require_not_null(df, schemas.NOT_NULL_COLUMNS[table], table)


def ingest_sensor_batch(spark: SparkSession, wh: Warehouse, batch: DataFrame, run_ts: dt.datetime,
                        cfg: PipelineConfig = DEFAULT) -> int:
    """Flag anomalies, replace the batch's plant-days, then log the load."""
    flagged = ingest.flag_anomalies(batch.drop("is_anomaly") if "is_anomaly" in batch.columns else batch, cfg)
    n = sinks.replace_plant_days(flagged, wh.path("raw_sensor_readings"), run_ts)
    sinks.log_run(spark, wh.log, run_ts, *C.LOG_SENSOR_LOAD, n, "success")
    return n


def ingest_country_csv(spark: SparkSession, wh: Warehouse, landed_csv: str, run_ts: dt.datetime) -> int:
    cleaned = ingest.clean_owid(readers.read_country_csv(spark, landed_csv), run_ts=run_ts)
    n = sinks.overwrite_table(_checked(cleaned, "raw_owid_emissions"), wh.path("raw_owid_emissions"))
    sinks.log_run(spark, wh.log, run_ts, *C.LOG_COUNTRY_LOAD, n, "success")
    return n


def ingest_benchmarks(spark: SparkSession, wh: Warehouse, run_ts: dt.datetime,
                      cfg: PipelineConfig = DEFAULT) -> int:
    n = sinks.overwrite_table(_checked(ingest.benchmark_rows(spark, cfg, run_ts), "raw_iea_benchmarks"),
                              wh.path("raw_iea_benchmarks"))
    sinks.log_run(spark, wh.log, run_ts, *C.LOG_BENCHMARK_LOAD, n, "success")
    return n


def ingest_air_quality(spark: SparkSession, wh: Warehouse, records: DataFrame, run_ts: dt.datetime) -> int:
    """Append parsed air-quality rows; an empty batch is neither written nor logged, and one that is
    loaded again (named by its rows) leaves one copy."""
    parsed = _checked(ingest.parse_air_quality(records, run_ts), "raw_openaq_readings")
    n = sinks.append_load(parsed, wh.path("raw_openaq_readings"))
    if n > 0:
        sinks.log_run(spark, wh.log, run_ts, *C.LOG_AIR_QUALITY_LOAD, n, "success")
    return n


def land_fixtures(spark: SparkSession, sf_dir: str, wh: Warehouse,
                  run_ts: dt.datetime = fixtures.RUN_TS, cfg: PipelineConfig = DEFAULT) -> dict[str, int]:
    """Load the driver's tables through the ingestion rules (files landed under the
    warehouse, as an upstream fetcher would leave them)."""
    out = {}
    out["raw_sensor_readings"] = ingest_sensor_batch(
        spark, wh, fixtures.unflagged_sensor_readings(spark, sf_dir), run_ts, cfg)
    csv = wh.path("landing/owid_csv")
    fixtures.owid_csv_frame(spark, sf_dir).write.mode("overwrite").option("header", True).csv(csv)
    out["raw_owid_emissions"] = ingest_country_csv(spark, wh, csv, run_ts)
    out["raw_iea_benchmarks"] = ingest_benchmarks(spark, wh, run_ts, cfg)
    js = wh.path("landing/openaq_json")
    fixtures.air_quality_bodies(spark, sf_dir).select("body").write.mode("overwrite").text(js)
    out["raw_openaq_readings"] = ingest_air_quality(
        spark, wh, readers.read_air_quality_records(spark, js), run_ts)
    return out


# --- transform (staging -> intermediate -> marts -> checks -> export) ------------------

@dataclass
class Work:
    """What a run rebuilds: None stands for everything."""
    changed: changes.Spans | None  # months whose readings are aggregated again
    months: changes.Spans | None   # months whose plant-days are replaced: these and what windows reach
    state: tuple[str, str] | None  # first and last month whose window state is replaced


def _last_day(spark: SparkSession, path: str) -> dt.date:
    """The first day of a plant-day table's last month, by its directories."""
    return dt.date.fromisoformat(f"{max(readers.months_of(spark, path), default='0001-01')}-01")


def _touched(spark: SparkSession, daily_path: str, schema: StructType, found: set[str], changed: DataFrame,
             since: dt.date | None) -> Work:
    """The work that changed months give once the aggregate has been written again: the months that
    their windows reach are found in it.  What the driver sees is a row per calendar month."""
    start = None if since is None else since.strftime("%Y-%m")
    first = min([*found, *([start] if start else [])])
    daily = readers.read_months(spark, daily_path, [(first, changes.OPEN_END)], schema).select(
        "reading_date", "plant_id", "reading_count")
    end = _last_day(spark, daily_path)
    touched = changes.touched_months(daily, changed, end).collect() if found else []
    reached = found | {r["reading_month"] for r in touched if r["reached"]}
    last = max([r["reading_month"] for r in touched] + [end.strftime("%Y-%m") if start else first])
    return Work(changes.spans(found, start), changes.spans(reached, start), (first, last))


def _window_state(spark: SparkSession, daily_path: str, schema: StructType, path: str, work: Work) -> DataFrame:
    """The new rows of the window-state table: the last reading days before and in each month."""
    days = readers.read_months(spark, daily_path, None if work.state is None else [work.state], schema)
    days = days.where(F.col("reading_count") > 0).select("reading_date", "plant_id", "scope1_intensity_avg")
    if work.state is None:
        return changes.window_state(days, None, _last_day(spark, daily_path))
    first, last = (dt.date.fromisoformat(f"{m}-01") for m in work.state)
    return changes.window_state(days.unionByName(_state_before(spark, path, work.state[0])), first, last)


def _state_before(spark: SparkSession, path: str, month: str) -> DataFrame:
    """The window state that holds when ``month`` begins: one directory of the table."""
    last = max((m for m in readers.months_of(spark, path) if m < month), default="")
    return readers.read_months(spark, path, [(last, last)], schemas.WINDOW_STATE).drop("reading_month")


def _with_windows(spark: SparkSession, daily: DataFrame, path: str, cfg: PipelineConfig,
                  work: Work) -> DataFrame:
    """Scope 1 of the run's months; their windows begin with the stored state before each stretch."""
    if work.months is None:
        return scopes.scope1_emissions(daily, cfg)
    history = [_state_before(spark, path, first).withColumn("span", F.lit(first)) for first, _ in work.months]
    month = sinks.reading_month()
    return scopes.scope1_emissions(daily.withColumn("span", changes.span_of(work.months, month)), cfg,
                                   reduce(DataFrame.unionByName, history))


def _settings(stg_iea: DataFrame, cfg: PipelineConfig, metered: bool) -> str:
    """A digest of what all plant-days depend on besides their readings: a run with others rebuilds all."""
    benchmarks = sinks.rows_digest(stg_iea.drop("ingested_at"))
    return hashlib.sha256(f"{cfg!r} {benchmarks} {metered}".encode()).hexdigest()


def transform(spark: SparkSession, wh: Warehouse, run_ts: dt.datetime,
              cfg: PipelineConfig = DEFAULT, export_dir: str | None = None,
              since: dt.date | None = None, scope2: DataFrame | None = None,
              full: bool = False) -> RunResult:
    """Run staging -> scopes -> marts -> checks -> export.

    The CO2 mart reads the stored Scope 2 and Scope 3 tables (a plant may replace them by
    metered values: see ``scope2`` below).

    After a first run, a run is driven by what changed: loads leave the plant-months they replaced
    beside the raw table, the run aggregates those months again, finds the months that their row-based
    windows reach, and replaces these in all tables and in the export.  Windows begin with a stored state,
    the last reading days before each month.  A run that fails leaves the changes to the next one.
    ``since`` adds the months from there on.  ``full`` rebuilds everything; so does a run without
    ``since`` whose configuration or benchmarks differ from the last one's.
    ``scope2`` takes the place of the estimated Scope 2 rows (reading_date, plant_id,
    scope2_intensity_kg_per_t, grid_emission_factor_kg_per_kwh, reading_count); what of it changed isn't
    known, so without ``since`` it means a full run, as does the next run without it.
    """
    res = RunResult()
    sensor_path, daily_path = wh.path("raw_sensor_readings"), wh.path("int_daily_plant_readings")
    state_path = wh.path("int_window_state")
    raw_owid = readers.read_owid_emissions(spark, wh.path("raw_owid_emissions"))
    raw_iea = readers.read_iea_benchmarks(spark, wh.path("raw_iea_benchmarks"))
    stg_owid = staging.stg_owid_emissions(raw_owid)
    stg_iea = staging.stg_iea_benchmarks(raw_iea, cfg)

    records, changed = sinks.pending_changes(spark, sensor_path)
    settings, known = _settings(stg_iea, cfg, scope2 is not None), None
    if sinks.path_exists(spark, wh.path("run_settings")):
        known = spark.read.parquet(wh.path("run_settings")).first()["settings"]
    if full or known is None or changed is None or (since is None and (scope2 is not None or known != settings)):
        since, found, work = None, set(), Work(None, None, None)
    else:
        found = {r[0] for r in changed.select("reading_month").distinct().collect()}
        work = Work(changes.spans(found, None if since is None else since.strftime("%Y-%m")), [], None)
    whole = work.changed is None

    def write(name: str, df: DataFrame) -> DataFrame:
        res.tables[name] = wh.path(name)
        res.rows[name] = sinks.overwrite_table(df, wh.path(name))
        return spark.read.parquet(wh.path(name))

    written: dict[str, StructType] = {}

    def write_days(name: str, df: DataFrame, months: changes.Spans | None) -> None:
        """Replace the run's months of a plant-day table."""
        res.tables[name], written[name] = wh.path(name), df.schema
        if whole:
            n = res.rows.get("int_daily_plant_readings")
            res.rows[name] = sinks.write_plant_days(df, wh.path(name)) if n is None else sinks.write_months(
                df.withColumn("reading_month", sinks.reading_month()), wh.path(name), None, n)
        else:
            rows = df.withColumn("reading_month", sinks.reading_month()).where(changes.within(months))
            res.rows[name] = sinks.write_months(rows, wh.path(name), months)

    def days_of(name: str, months: changes.Spans | None) -> DataFrame:
        """Stored plant-days of the run's months."""
        return readers.read_months(spark, wh.path(name), months, written.get(name)).drop("reading_month")

    # One listing of the raw table serves the checks of all of it and the aggregate: of all
    # readings, or of those of the changed months.
    stored_sensor = readers.read_stored_sensor(spark, sensor_path)
    raw_sensor = stored_sensor.select(*schemas.RAW_SENSOR_READINGS.names)
    scanned = raw_sensor if whole else stored_sensor.where(changes.within(work.changed)).select(*raw_sensor.columns)

    write("stg_owid_emissions", stg_owid)
    marts_of_run = ("mart_co2_intensity", "mart_net_zero_progress", "mart_benchmark_gap")
    if whole or work.changed:
        # intermediate: one aggregate of the readings, then plant-day sized tables
        stg_sensor = staging.stg_sensor_readings(scanned, cfg)
        daily_rows = scopes.daily_plant_readings(stg_sensor)
        write_days("int_daily_plant_readings", daily_rows, work.changed)
        if not whole:
            work = _touched(spark, daily_path, daily_rows.schema, found, changed, since)
        expected = res.rows["int_daily_plant_readings"] if whole else None
        sinks.write_months(_window_state(spark, daily_path, daily_rows.schema, state_path, work), state_path,
                           None if whole else [work.state], expected)
        daily = days_of("int_daily_plant_readings", work.months)
        write_days("int_scope1_emissions", _with_windows(spark, daily, state_path, cfg, work), work.months)
        s1 = days_of("int_scope1_emissions", work.months)
        write_days("int_scope2_emissions", scopes.scope2_emissions(daily) if scope2 is None else scope2, work.months)
        write_days("int_scope3_emissions", scopes.scope3_emissions(s1), work.months)

        # marts: LEFT JOINs of the stored scopes, sized by the plant-days of these months
        s2, s3 = (days_of(f"int_scope{i}_emissions", work.months) for i in (2, 3))
        write_days(marts_of_run[0], marts.co2_intensity_joined(s1, s2, s3, run_ts), work.months)
        co2 = days_of(marts_of_run[0], work.months)
        write_days(marts_of_run[1], marts.net_zero_progress(co2, cfg), work.months)
        write_days(marts_of_run[2], marts.benchmark_gap(co2, stg_iea), work.months)
    else:
        res.tables.update({name: wh.path(name) for name in marts_of_run})
        res.rows.update({name: 0 for name in marts_of_run})
    whole_co2 = days_of("mart_co2_intensity", None)

    # checks: of the whole tables, reported and logged, never blocking the export
    results = write("data_test_results", quality.check_results_from_raw(
        raw_sensor, raw_owid, raw_iea, whole_co2, cfg))
    sinks.log_record(spark, wh.log, quality.check_log_record(results, run_ts), run_ts, *C.LOG_DATA_TESTS)
    # Every row stamped by a load since the last run lies in the re-read months, so the stored
    # maximum and theirs give the table's maximum.
    previous = None
    if not whole and sinks.path_exists(spark, wh.path("source_freshness")):
        previous = spark.read.parquet(wh.path("source_freshness"))
    write("source_freshness", quality.freshness(scanned, "raw_sensor_readings", run_ts,
                                                previous=previous))

    # export, newest first, one mart failing does not stop the others
    export_root = export_dir or wh.path("exports")
    for name in marts_of_run:
        try:
            target = os.path.join(export_root, name)
            months = work.months if sinks.exported_by_month(spark, target) else None
            n = sinks.export_months(days_of(name, months), target, months)
            res.exported.append(f"{name}: {n} rows")
        except Exception as e:  # noqa: BLE001 - isolate each mart, report below
            res.export_failures.append(f"{name}: {type(e).__name__}: {str(e).splitlines()[0]}")
    status = "success" if not res.export_failures else "failed"
    sinks.log_run(spark, wh.log, run_ts, *C.LOG_EXPORT, len(res.exported), status,
                  "; ".join(res.exported + res.export_failures))
    if not res.export_failures:  # else the next run does these months again
        if known != settings:
            settings = settings if since is None else "mixed"  # months before ``since`` have the old ones
            sinks.overwrite_table(spark.createDataFrame([(settings,)], "settings string"), wh.path("run_settings"))
        sinks.take_in_changes(spark, sensor_path, records)
    return res


def run_all(spark: SparkSession, sf_dir: str, root: str, run_ts: dt.datetime = fixtures.RUN_TS,
            cfg: PipelineConfig = DEFAULT) -> RunResult:
    """Land the driver's data, then run the full transform."""
    wh = Warehouse(root)
    loaded = land_fixtures(spark, sf_dir, wh, run_ts, cfg)
    res = transform(spark, wh, run_ts, cfg)
    res.rows.update(loaded)
    return res


def pipeline_log(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return readers.read_pipeline_log(spark, wh.log).orderBy(F.desc("run_at"))
