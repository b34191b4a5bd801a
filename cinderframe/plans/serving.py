"""Report queries served from the stored marts of a warehouse (the dashboard's data)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, PipelineConfig
from ..operators import reports
from ..sources import readers
from .pipeline import Warehouse

REPORTS = ["latest", "trend", "progress", "benchmark", "scope_breakdown", "pipeline_log", "kpi",
           "scope_share", "benchmark_latest"]


def report(spark: SparkSession, wh: Warehouse, name: str, as_of: dt.date,
           days: int | None = None, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One report over the stored marts; ``days`` is the window of the windowed reports."""
    days = days if days is not None else cfg.report_days
    co2 = readers.read_plant_days(spark, wh.path("mart_co2_intensity"))
    if name == "latest":
        return reports.latest_per_plant(co2)
    if name == "trend":
        return reports.trend(co2, as_of, days)
    if name == "scope_breakdown":
        return reports.scope_breakdown(co2, as_of, days)
    if name == "kpi":
        return reports.kpi(co2, cfg)
    if name == "scope_share":
        return reports.scope_share(co2)
    if name == "progress":
        return reports.progress(readers.read_plant_days(spark, wh.path("mart_net_zero_progress")), as_of, days)
    if name == "benchmark":
        return reports.benchmark(readers.read_plant_days(spark, wh.path("mart_benchmark_gap")), as_of, days)
    if name == "benchmark_latest":
        return reports.benchmark_latest(readers.read_plant_days(spark, wh.path("mart_benchmark_gap")), as_of, days)
    if name == "pipeline_log":
        return reports.pipeline_log_recent(readers.read_pipeline_log(spark, wh.log))
    raise ValueError(f"unknown report {name!r}; one of {REPORTS}")


def all_reports(spark: SparkSession, wh: Warehouse, as_of: dt.date, days: int | None = None,
                cfg: PipelineConfig = DEFAULT) -> dict[str, DataFrame]:
    return {name: report(spark, wh, name, as_of, days, cfg) for name in REPORTS}
