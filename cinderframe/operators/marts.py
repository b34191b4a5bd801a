"""Mart models: CO2 intensity, net-zero progress and benchmark gap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions.timeutil import ts_lit
from ..functions import (as_decimal, dec, global_status, industry_position, round_half_up,
                         safe_div, status_2030)
from .scopes import KEYS, scope2_intensity, scope3_columns

def _co2_projection(rows: DataFrame, run_ts: dt.datetime | None) -> DataFrame:
    s1 = F.col("scope1_intensity_avg")
    s2 = F.col("scope2_intensity_kg_per_t")
    s3 = F.col("scope3_total_kg_per_t")
    return rows.select(
        *KEYS,
        round_half_up(s1, 2).alias("scope1_kg_per_t"),
        round_half_up("scope1_rolling_7d", 2).alias("scope1_7d_avg"),
        round_half_up("scope1_rolling_30d", 2).alias("scope1_30d_avg"),
        round_half_up(s2, 2).alias("scope2_kg_per_t"),
        round_half_up(s3, 2).alias("scope3_kg_per_t"),
        # The total rounds the unrounded sum; a missing scope makes it NULL (no COALESCE).
        round_half_up(s1 + s2 + s3, 2).alias("total_co2_kg_per_t"),
        "reading_count", "anomaly_count", "exceeds_2030_target",
        ts_lit(run_ts).alias("updated_at"),
    )


def co2_intensity(scope1: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """CO2 intensity mart (Scope 1+2+3, 2 dp) from the Scope 1 rows.

    Scope 2 and Scope 3 are per-tonne constants defined on every Scope 1 plant-day (Scope 2
    covers a superset of those days, Scope 3 the same days), so the left joins of the model
    always match exactly one row.  Attaching the values on the same row gives the joined
    result without re-scanning the readings for Scope 2 or shuffling for the joins.
    ``co2_intensity_joined`` is the join form for independently materialized scope tables.
    """
    rows = (scope1.withColumn("scope2_intensity_kg_per_t", scope2_intensity().cast("double"))
            .withColumn("scope3_total_kg_per_t", scope3_columns()[2]))
    return _co2_projection(rows, run_ts)


def co2_intensity_joined(scope1: DataFrame, scope2: DataFrame, scope3: DataFrame,
                         run_ts: dt.datetime | None = None) -> DataFrame:
    """The same mart as two LEFT equi-joins on (reading_date, plant_id).

    For scope tables produced independently (e.g. a metered Scope 2): they hold one row per
    plant-day, so the joins are sized by plant-days, not by readings.  For the scopes built
    here it gives the same rows as ``co2_intensity`` (tested), which needs no join.
    """
    rows = (scope1
            .join(scope2.select(*KEYS, "scope2_intensity_kg_per_t"), KEYS, "left")
            .join(scope3.select(*KEYS, "scope3_total_kg_per_t"), KEYS, "left"))
    return _co2_projection(rows, run_ts)


def net_zero_progress(co2: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Progress toward the 2030 and 2050 targets, in exact decimal arithmetic.

    Progress is floored at 0 and not capped at 100; ``GREATEST`` skips NULL, so a NULL
    intensity gives 0.0.  The annual reduction divides by the years left to 2050 (NULL in
    2050, negative after).
    """
    cur = as_decimal("scope1_kg_per_t")
    base, t30, t50 = dec(cfg.baseline_intensity), dec(cfg.target_2030), dec(cfg.target_2050)
    zero = F.lit(0)
    years_left = (F.lit(C.NET_ZERO_YEAR) - F.year("reading_date")).cast("decimal(10,0)")
    return co2.select(
        *KEYS,
        F.col("scope1_kg_per_t").alias("current_intensity"),
        F.lit(cfg.baseline_intensity).alias("baseline_2020"),
        F.lit(cfg.target_2030).alias("target_2030"),
        F.lit(cfg.target_2050).alias("target_2050"),
        (cur - t30).cast("double").alias("gap_vs_2030_target"),
        (cur - t50).cast("double").alias("gap_vs_2050_target"),
        round_half_up(F.greatest(zero, safe_div(base - cur, base - t30) * 100), 1)
        .alias("progress_pct_to_2030"),
        round_half_up(F.greatest(zero, safe_div(base - cur, base) * 100), 1)
        .alias("progress_pct_to_2050"),
        status_2030(F.col("scope1_kg_per_t"), cfg.target_2030, cfg.near_target_factor)
        .alias("status_2030"),
        round_half_up(safe_div(cur - t50, years_left), 2).alias("required_annual_reduction"),
        "updated_at",
    )


def status_distribution(net_zero: DataFrame) -> DataFrame:
    """Plant-days per 2030 status."""
    return net_zero.groupBy("status_2030").agg(F.count(F.lit(1)).alias("plant_days"))


def benchmark_values(stg_iea: DataFrame) -> F.Column:
    """The benchmark values as ONE scalar subquery: a struct of three lists, one entry per staged
    row of that (year, region).

    The subquery runs once, before the main plan, and its result is inlined: the plant-day
    rows are neither joined nor shuffled.  Entries are wrapped, so that a NULL value counts as
    a row.
    """
    year, region = F.col("year"), F.col("region")
    parts = {
        "global_avg": (year == C.BENCHMARK_YEAR) & (region == C.GLOBAL_REGION),
        "asean_avg": (year == C.BENCHMARK_YEAR) & (region == C.ASEAN_REGION),
        "scg_2030_target": (year == C.OWN_TARGET_YEAR) & (region == C.OWN_TARGET_REGION),
    }
    entry = F.struct(F.col("co2_intensity_kg_per_t").alias("v"))
    fields = [F.collect_list(F.when(match, entry)).alias(name) for name, match in parts.items()]
    wanted = parts["global_avg"] | parts["asean_avg"] | parts["scg_2030_target"]
    return stg_iea.where(wanted).agg(F.struct(*fields).alias("benchmarks")).scalar()


def benchmark_gap(co2: DataFrame, stg_iea: DataFrame) -> DataFrame:
    """Gap of each plant-day against the global and ASEAN benchmarks and the own target.

    The benchmark values are attached from a scalar subquery (``benchmark_values``).  As in
    the original, a missing benchmark row yields no mart rows, and a benchmark (year, region)
    that two loads hold yields a mart row for each.
    """
    names = ["global_avg", "asean_avg", "scg_2030_target"]
    rows = co2.withColumn("_benchmarks", benchmark_values(stg_iea))
    for n in names:
        rows = rows.withColumn(f"_{n}", F.explode(F.col("_benchmarks")[n]))
    b = {n: F.col(f"_{n}.v") for n in names}
    cur = F.col("scope1_kg_per_t")
    gavg, aavg, target = b["global_avg"], b["asean_avg"], b["scg_2030_target"]
    return rows.select(
        *KEYS,
        cur.alias("scg_intensity"),
        gavg.alias("global_avg"),
        round_half_up(cur - gavg, 2).alias("gap_vs_global"),
        global_status(cur, gavg).alias("global_status"),
        aavg.alias("asean_avg"),
        round_half_up(cur - aavg, 2).alias("gap_vs_asean"),
        target.alias("scg_2030_target"),
        round_half_up(cur - target, 2).alias("gap_vs_scg_target"),
        industry_position(cur, gavg).alias("industry_position"),
        "updated_at",
    )
