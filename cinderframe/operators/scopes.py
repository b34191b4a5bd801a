"""Intermediate models: daily Scope 1, 2 and 3 per plant.

All three scopes come from ONE grouped aggregate over the staged readings
(``daily_plant_readings``).  Written separately, Scope 1 and Scope 2 would each group the
raw readings, and column pruning would make their aggregates differ, so the raw table
would be scanned and shuffled twice.  With the fused aggregate the raw rows are read once,
reduced map-side (partial aggregation: a hot plant-day collapses to one row per task
before the shuffle) and shuffled as plant-day partials.

The rolling windows then run on one row per plant-day.  Their partition is one plant's
history of days, which stays small however many raw readings a plant has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions import dec

KEYS = ["reading_date", "plant_id"]


def daily_plant_readings(stg: DataFrame) -> DataFrame:
    """Per plant-day aggregates needed by every scope, in one pass.

    Scope 1 statistics cover only the CO2-bearing rows (direct intensity and converted
    heat), i.e. rows with a non-null ``co2_kg_per_t``; AVG/MIN/MAX/STDDEV skip NULLs, so
    they equal the filtered aggregates.  ``reading_count``/``anomaly_count`` are counted
    over those rows; ``all_reading_count`` over every staged row (Scope 2's count).
    """
    co2 = F.col("co2_kg_per_t")
    bearing = co2.isNotNull()
    return stg.groupBy(*KEYS).agg(
        F.avg(co2).alias("scope1_intensity_avg"),
        F.min(co2).alias("scope1_intensity_min"),
        F.max(co2).alias("scope1_intensity_max"),
        F.stddev_samp(co2).alias("scope1_intensity_std"),
        F.avg(F.when(bearing, F.col("heat_mj_per_t"))).alias("heat_consumption_avg"),
        # Coal rows carry no CO2 value, so after the Scope 1 row filter this sum is always
        # NULL.  Kept deliberately: it is what the original model computes.
        F.sum(F.when(bearing, F.col("coal_t_per_day"))).alias("coal_total_t_day"),
        F.count(co2).alias("reading_count"),
        F.count_if(bearing & F.col("is_anomaly")).alias("anomaly_count"),
        F.count(F.lit(1)).alias("all_reading_count"),
        F.avg(F.when(F.col("sensor") == C.O2_SENSOR, F.col("raw_value"))).alias("o2_avg"),
    )


def co2_bearing(stg: DataFrame) -> DataFrame:
    """The staged rows that carry a CO2 value: direct intensity and converted heat.

    The predicate is on a stored column, so a Scope 1 run that needs nothing else reads (and
    shuffles) two of the sensors only; ``daily_plant_readings`` of these rows has the same
    Scope 1 columns as that of all rows."""
    return stg.where(F.col("sensor").isin(C.CO2_SENSOR, C.HEAT_SENSOR))


def plant_day_window() -> Window:
    return Window.partitionBy("plant_id").orderBy("reading_date")


def scope1_emissions(daily: DataFrame, cfg: PipelineConfig = DEFAULT,
                     history: DataFrame | None = None) -> DataFrame:
    """Daily Scope 1 statistics with row-based rolling means and the 30-row change.

    "7-day"/"30-day" are 7 and 30 available reading days (ROWS frames); the first rows of a
    plant use partial frames and the change is NULL for its first 30 days.

    ``history`` (span, reading_date, plant_id, scope1_intensity_avg) has the reading days before
    each ``span`` of ``daily``, which then has that column too: input of the windows, no rows.
    """
    avg = F.col("scope1_intensity_avg")
    w = plant_day_window()
    s1 = daily.where(F.col("reading_count") > 0)
    if history is not None:
        w = Window.partitionBy("span", "plant_id").orderBy("reading_date")
        s1 = s1.withColumn("is_row", F.lit(True)).unionByName(
            history.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    else:
        s1 = s1.withColumn("is_row", F.lit(True))
    return s1.select(
        "is_row",
        *KEYS,
        "scope1_intensity_avg", "scope1_intensity_min", "scope1_intensity_max",
        "scope1_intensity_std", "heat_consumption_avg", "coal_total_t_day",
        "reading_count", "anomaly_count",
        F.avg(avg).over(w.rowsBetween(-(C.ROLLING_SHORT_ROWS - 1), 0)).alias("scope1_rolling_7d"),
        F.avg(avg).over(w.rowsBetween(-(C.ROLLING_LONG_ROWS - 1), 0)).alias("scope1_rolling_30d"),
        (avg - F.lag(avg, C.CHANGE_LAG_ROWS).over(w)).alias("scope1_mom_change"),
        (avg > cfg.target_2030).alias("exceeds_2030_target"),
    ).where("is_row").drop("is_row")


def scope2_intensity() -> "F.Column":
    """kWh per tonne x grid factor, as an exact decimal product (54.98900)."""
    return dec(C.ELECTRICITY_KWH_PER_T) * dec(C.GRID_FACTOR_KG_PER_KWH)


def scope2_emissions(daily: DataFrame) -> DataFrame:
    """Scope 2 per plant-day: a per-tonne electricity estimate and the day's reading count.

    Every plant-day with any staged reading has a row (a superset of the Scope 1 days).
    """
    return daily.select(
        *KEYS,
        scope2_intensity().cast("double").alias("scope2_intensity_kg_per_t"),
        dec(C.GRID_FACTOR_KG_PER_KWH).cast("double").alias("grid_emission_factor_kg_per_kwh"),
        F.col("all_reading_count").alias("reading_count"),
    )


def o2_daily(daily: DataFrame) -> DataFrame:
    """The flue-gas O2 mean per plant-day, computed beside Scope 2 (not used by any mart)."""
    return daily.select(*KEYS, "o2_avg", F.col("all_reading_count").alias("reading_count"))


def scope3_columns() -> list:
    upstream = dec(C.SCOPE3_LIMESTONE_KG_PER_T) + dec(C.SCOPE3_COAL_TRANSPORT_KG_PER_T)
    downstream = dec(C.SCOPE3_DISTANCE_KM) * dec(C.SCOPE3_TRUCK_KG_PER_T_KM)
    return [
        upstream.cast("double").alias("scope3_upstream_kg_per_t"),
        downstream.cast("double").alias("scope3_downstream_kg_per_t"),
        (upstream + downstream).cast("double").alias("scope3_total_kg_per_t"),
        F.lit(C.SCOPE3_DATA_SOURCE).alias("data_source"),
    ]


def scope3_emissions(scope1: DataFrame) -> DataFrame:
    """Scope 3 value-chain estimate: one row for each Scope 1 plant-day."""
    return scope1.select(*KEYS, *scope3_columns())
