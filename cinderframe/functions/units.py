"""Unit conversions and classifications, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .numeric import as_decimal, dec


def co2_kg_per_t(sensor: Column, value: Column) -> Column:
    """kg CO2 per tonne of cement: direct intensity passes through, heat consumption is
    converted (kcal/kg clinker x emission factor x clinker ratio); other sensors NULL."""
    return (F.when(sensor == C.CO2_SENSOR, value)
            .when(sensor == C.HEAT_SENSOR, value * C.HEAT_TO_CO2_FACTOR * C.CLINKER_TO_CEMENT_RATIO))


def heat_mj_per_t(sensor: Column, value: Column) -> Column:
    """kcal -> MJ for the heat sensor (the factor yields MJ per kg, as the name is kept)."""
    return F.when(sensor == C.HEAT_SENSOR, value * C.KCAL_TO_MJ_MULTIPLIER / C.KCAL_TO_MJ_DIVISOR)


def coal_t_per_day(sensor: Column, value: Column) -> Column:
    """t/h -> t/day for the coal feed sensor."""
    return F.when(sensor == C.COAL_SENSOR, value * C.HOURS_PER_DAY)


def out_of_limits(value: Column, lo: Column, hi: Column) -> Column:
    """Strict limit check used to flag anomalies."""
    return (value < lo) | (value > hi)


def status_2030(intensity: Column, target_2030: int, near_factor) -> Column:
    """on_track (<= target) / near_target (<= target x 1.05) / off_track; NULL -> off_track."""
    t = dec(target_2030)
    x = as_decimal(intensity)
    return (F.when(x <= t, "on_track")
            .when(x <= t * dec(near_factor), "near_target")
            .otherwise("off_track"))


def global_status(intensity: Column, global_avg: Column) -> Column:
    return F.when(intensity < global_avg, "better_than_global").otherwise("worse_than_global")


def industry_position(intensity: Column, global_avg: Column) -> Column:
    """Band against the global average: < x0.9, < x1, < x1.1, else bottom."""
    return (F.when(intensity < global_avg * C.TOP_BAND_FACTOR, "top_10pct")
            .when(intensity < global_avg, "above_average")
            .when(intensity < global_avg * C.BOTTOM_BAND_FACTOR, "below_average")
            .otherwise("bottom_10pct"))


def kpi_band(intensity: Column, target_2030: int) -> Column:
    """Severity colour of the headline KPI."""
    return (F.when(intensity > target_2030 * 1.05, "red")
            .when(intensity > target_2030, "orange")
            .otherwise("green"))
