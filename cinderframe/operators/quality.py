"""Data-quality checks: NOT NULL column tests, the two singular intensity tests, source
freshness and the result summary.

Every check is an aggregate.  All checks on one table share a single pass over it (one
``count_if`` per check), and results are small frames of check rows -- nothing is
collected to the driver.  Failing checks are reported, they never block later steps.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions.timeutil import ts_lit

# The sixteen tests: NOT NULL columns per table, then the two singular tests on the mart.
NOT_NULL_TESTS = {
    "raw_sensor_readings": ["reading_date", "plant_id", "sensor", "value"],
    "raw_owid_emissions": ["year", "country"],
    "raw_iea_benchmarks": ["year", "sector", "metric"],
    "stg_sensor_readings": ["reading_date", "plant_id", "sensor"],
    "mart_co2_intensity": ["reading_date", "scope1_kg_per_t"],
}
NOT_NEGATIVE_TEST = "co2_not_negative"
RANGE_TEST = "intensity_reasonable_range"
RANGE_ISSUE = "out_of_reasonable_range"


def _status(failures: F.Column) -> F.Column:
    return F.when(failures > 0, "fail").otherwise("pass")


def _checks_of_table(df: DataFrame, table: str, checks: list[tuple[str, str, F.Column]]) -> DataFrame:
    """One aggregate pass evaluating every (test_name, column, violation predicate) of a table,
    unpivoted to one row per check."""
    agg = df.agg(*[F.count_if(pred).alias(f"c{i}") for i, (_, _, pred) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("test_name"), F.lit(table).alias("table_name"),
                 F.lit(col).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, (name, col, _) in enumerate(checks)
    ])
    return agg.select(F.inline(rows))


def not_null_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """NOT NULL tests: one row per (table, column) with the count of NULLs."""
    frames = []
    for table, cols in NOT_NULL_TESTS.items():
        if table not in tables:
            continue
        checks = [(f"not_null_{table}_{c}", c, F.col(c).isNull()) for c in cols]
        frames.append(_checks_of_table(tables[table], table, checks))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("status", _status(F.col("failures")))


def reading_not_null_checks(raw_sensor: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """NOT NULL tests of the raw and the staged readings in ONE pass over the raw table.

    Only rows with a NULL in a tested column can fail, and that predicate reaches the scan:
    row groups without NULLs are skipped by their statistics.  So the whole table is tested
    in every run, also an incremental one, for little more than its file footers.  A staged row is a raw row that passes the staging predicate (staged key columns are
    raw columns), so its NULL count is ``count_if(kept AND col IS NULL)`` on the raw rows.
    """
    from .staging import kept_reading

    kept = kept_reading(cfg)
    checks = [(f"not_null_raw_sensor_readings_{c}", "raw_sensor_readings", c, F.col(c).isNull())
              for c in NOT_NULL_TESTS["raw_sensor_readings"]]
    checks += [(f"not_null_stg_sensor_readings_{c}", "stg_sensor_readings", c, kept & F.col(c).isNull())
               for c in NOT_NULL_TESTS["stg_sensor_readings"]]
    # plant_id is a directory of the stored table: its predicate prunes apart from the others'.
    stored = [F.col(c).isNull() for c in NOT_NULL_TESTS["raw_sensor_readings"] if c != "plant_id"]
    suspects = raw_sensor.where(reduce(or_, stored)).unionByName(
        raw_sensor.where(F.col("plant_id").isNull() & ~reduce(or_, stored)))
    agg = suspects.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(f"c{i}")
                           for i, (_, _, _, p) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("test_name"), F.lit(table).alias("table_name"),
                 F.lit(col).alias("column_name"), F.col(f"c{i}").alias("failures"))
        for i, (name, table, col, _) in enumerate(checks)
    ])
    return agg.select(F.inline(rows)).withColumn("status", _status(F.col("failures")))


def check_results_from_raw(raw_sensor: DataFrame, raw_owid: DataFrame, raw_iea: DataFrame,
                          co2: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The sixteen tests with the staged-reading tests derived from the raw pass."""
    small = not_null_checks({"raw_owid_emissions": raw_owid, "raw_iea_benchmarks": raw_iea})
    mart = mart_checks(co2, cfg).withColumn("status", _status(F.col("failures")))
    return reading_not_null_checks(raw_sensor, cfg).unionByName(small).unionByName(mart)


def negative_intensity(co2: DataFrame) -> DataFrame:
    """Singular test: plant-days with a negative Scope 1 intensity (any row = failure)."""
    return co2.where(F.col("scope1_kg_per_t") < 0).select("reading_date", "plant_id", "scope1_kg_per_t")


def out_of_range_intensity(co2: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Singular test: plant-days outside the plausible 200-1200 kg/t range."""
    lo, hi = cfg.reasonable_range
    x = F.col("scope1_kg_per_t")
    return (co2.where((x < lo) | (x > hi))
            .select("reading_date", "plant_id", "scope1_kg_per_t", F.lit(RANGE_ISSUE).alias("issue")))


def mart_checks(co2: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """NOT NULL and both singular tests of the CO2 mart in one pass."""
    lo, hi = cfg.reasonable_range
    x = F.col("scope1_kg_per_t")
    checks = [(f"not_null_mart_co2_intensity_{c}", c, F.col(c).isNull())
              for c in NOT_NULL_TESTS["mart_co2_intensity"]]
    checks += [(NOT_NEGATIVE_TEST, "scope1_kg_per_t", x < 0),
               (RANGE_TEST, "scope1_kg_per_t", (x < lo) | (x > hi))]
    return _checks_of_table(co2, "mart_co2_intensity", checks)


def check_summary(results: DataFrame) -> DataFrame:
    """Number of tests per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tests"))


def check_log_record(results: DataFrame, run_at: dt.datetime) -> DataFrame:
    """The audit-log row of a test run: passed count, and ``warning`` when any test failed."""
    passed = F.count_if(F.col("status") == "pass")
    failed = F.count_if(F.col("status") == "fail")
    agg = results.agg(passed.alias("passed"), failed.alias("failed"))
    return agg.select(
        ts_lit(run_at).alias("run_at"),
        F.lit(C.LOG_DATA_TESTS[0]).alias("dag_id"),
        F.lit(C.LOG_DATA_TESTS[1]).alias("source"),
        F.col("passed").cast("int").alias("rows_loaded"),
        F.when(F.col("failed") == 0, "success").otherwise("warning").alias("status"),
        F.format_string("%d passed, %d failed", "passed", "failed").alias("message"),
    )


def freshness_status(latest: DataFrame, source: str, run_ts: dt.datetime,
                     warn_days: int = C.FRESHNESS_WARN_DAYS,
                     error_days: int = C.FRESHNESS_ERROR_DAYS) -> DataFrame:
    """Classify a one-row frame holding ``max_loaded_at``."""
    now = ts_lit(run_ts)
    age_s = F.unix_timestamp(now) - F.unix_timestamp(F.col("max_loaded_at"))
    return latest.select(
        F.lit(source).alias("source"),
        "max_loaded_at",
        (age_s / 3600.0).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age_s > error_days * 86400), "error")
        .when(age_s > warn_days * 86400, "warn")
        .otherwise("pass").alias("status"),
    )


def freshness(df: DataFrame, source: str, run_ts: dt.datetime, loaded_at: str = "ingested_at",
              warn_days: int = C.FRESHNESS_WARN_DAYS, error_days: int = C.FRESHNESS_ERROR_DAYS,
              previous: DataFrame | None = None) -> DataFrame:
    """Source freshness on ``MAX(loaded_at)``: ``error`` when older than 5 days, ``warn`` when
    older than 2, else ``pass``; an empty source is an error.  ``previous`` holds a maximum
    stored earlier, for a run that scans newly loaded days only."""
    latest = df.select(F.col(loaded_at).cast("timestamp").alias("max_loaded_at"))
    if previous is not None:
        latest = latest.unionByName(previous.select("max_loaded_at"))
    latest = latest.agg(F.max("max_loaded_at").alias("max_loaded_at"))
    return freshness_status(latest, source, run_ts, warn_days, error_days)
