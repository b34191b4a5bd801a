"""Staging models: lazy views over the raw tables (no storage)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions import co2_kg_per_t, coal_t_per_day, heat_mj_per_t, round_half_up, safe_div


def kept_reading(cfg: PipelineConfig = DEFAULT) -> F.Column:
    """The staging predicate: a positive, non-null value of a configured sensor."""
    v = F.col("value")
    return v.isNotNull() & (v > 0) & F.col("sensor").isin(cfg.sensor_names)


def stg_sensor_readings(raw: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Clean sensor readings and convert units.

    Keeps positive, non-null values of the configured sensors.  Both predicates are on
    stored columns, so on a Parquet source they are pushed into the scan.
    """
    v, s = F.col("value"), F.col("sensor")
    kept = raw.where(kept_reading(cfg))
    return kept.select(
        "reading_date", "plant_id", "sensor",
        v.alias("raw_value"),
        F.col("unit_label").alias("raw_unit"),
        "is_anomaly", "ingested_at",
        co2_kg_per_t(s, v).alias("co2_kg_per_t"),
        heat_mj_per_t(s, v).alias("heat_mj_per_t"),
        coal_t_per_day(s, v).alias("coal_t_per_day"),
    )


def stg_owid_emissions(raw: DataFrame) -> DataFrame:
    """Valid country-years with NULL measures as 0 and the cement share in percent (2 dp).

    As in the original model, the share uses the raw cement value, so a missing cement
    value gives ``cement_co2_mt = 0`` but a NULL share; and the ``co2_total_mt > 0`` filter
    makes the zero default and the CASE's ELSE branch unreachable (kept as written).
    """
    total = F.col("co2_total_mt")
    kept = raw.where(F.col("year").isNotNull() & F.col("country").isNotNull() & (total > 0))
    share = F.when(total > 0, round_half_up(safe_div(F.col("cement_co2"), total) * 100, 2))
    return kept.select(
        "year", "country",
        F.coalesce(total, F.lit(0.0)).alias("co2_total_mt"),
        F.coalesce("co2_per_capita", F.lit(0.0)).alias("co2_per_capita"),
        F.coalesce("cement_co2", F.lit(0.0)).alias("cement_co2_mt"),
        F.coalesce("energy_co2", F.lit(0.0)).alias("energy_co2_mt"),
        share.alias("cement_co2_share_pct"),
        "ingested_at",
    )


def stg_iea_benchmarks(raw: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Benchmarks of the cement sector pivoted to one row per year/sector/region/load.

    Grouping includes ``ingested_at``: one load carries one timestamp, so each region has one
    row; rows of two different loads would stay apart.
    """
    m, val = F.col("metric"), F.col("value")
    pivoted = (raw.where(F.col("sector") == C.BENCHMARK_SECTOR)
               .groupBy("year", "sector", "region", "ingested_at")
               .agg(F.max(F.when(m == "co2_intensity", val)).alias("co2_intensity_kg_per_t"),
                    F.max(F.when(m == "heat_consumption", val)).alias("heat_consumption_mj_per_t")))
    return pivoted.select(
        "year", "sector", "region", "co2_intensity_kg_per_t", "heat_consumption_mj_per_t",
        F.lit(cfg.target_2030).alias("scg_target_2030"),
        F.lit(cfg.target_2050).alias("scg_target_2050"),
        F.lit(cfg.baseline_intensity).alias("baseline_2020"),
        "ingested_at",
    )


def order_benchmarks(stg_iea: DataFrame) -> DataFrame:
    """Presentation order of the benchmark view (region NULLs last, as in the source DB)."""
    return stg_iea.orderBy(F.asc_nulls_last("region"), F.asc("year"))


def order_countries(stg_owid: DataFrame) -> DataFrame:
    return stg_owid.orderBy("country", "year")
