"""Pipeline configuration.

Everything company- or site-specific is a field here, so the same transformations run for
one plant or for thousands.  `as_of` and `run_ts` replace the wall clock: nothing in the
library reads the current time, which keeps every run reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class SensorSpec:
    name: str
    unit: str
    lo: float
    hi: float


# ---------------------------------------------------------------------------------------
# Fixed values.  These must equal the values of the pipeline being replaced, so results
# agree; they are listed here plainly, in their natural order.
# ---------------------------------------------------------------------------------------

# The seven kiln sensors, their units and the (exclusive) plausible limits used to flag
# a reading as an anomaly.
SENSORS: tuple[SensorSpec, ...] = (
    SensorSpec("CO2_emission_intensity", "kg_CO2_per_t_cement", 600.0, 800.0),
    SensorSpec("specific_heat_consumption", "kcal_per_kg_clinker", 680.0, 820.0),
    SensorSpec("coal_consumption_rate", "t_per_hr", 5.0, 15.0),
    SensorSpec("NOx_emission", "mg_per_Nm3", 0.0, 800.0),
    SensorSpec("dust_emission", "mg_per_Nm3", 0.0, 20.0),
    SensorSpec("SO2_emission", "mg_per_Nm3", 0.0, 200.0),
    SensorSpec("O2_flue_gas", "pct", 1.0, 5.0),
)

CO2_SENSOR = "CO2_emission_intensity"
HEAT_SENSOR = "specific_heat_consumption"
COAL_SENSOR = "coal_consumption_rate"
O2_SENSOR = "O2_flue_gas"

# Unit conversions (applied left to right, in this order).
HEAT_TO_CO2_FACTOR = 0.0946        # kg CO2 per kcal of coal heat
CLINKER_TO_CEMENT_RATIO = 0.95
KCAL_TO_MJ_MULTIPLIER = 4.184      # then divided by 1000
KCAL_TO_MJ_DIVISOR = 1000
HOURS_PER_DAY = 24

# Scope 2 and Scope 3 constants, as exact decimals.
ELECTRICITY_KWH_PER_T = Decimal("110.0")
GRID_FACTOR_KG_PER_KWH = Decimal("0.4999")
SCOPE3_LIMESTONE_KG_PER_T = Decimal("15.0")
SCOPE3_COAL_TRANSPORT_KG_PER_T = Decimal("5.0")
SCOPE3_DISTANCE_KM = Decimal("200.0")
SCOPE3_TRUCK_KG_PER_T_KM = Decimal("0.1")
SCOPE3_DATA_SOURCE = "industry_estimate"

# Net-zero targets (kg CO2 per tonne of cement).
BASELINE_INTENSITY = 800
TARGET_2030 = 650
TARGET_2050 = 0
NEAR_TARGET_FACTOR = Decimal("1.05")
NET_ZERO_YEAR = 2050

# Benchmark rows: (year, sector, region, metric, value, unit).
BENCHMARK_ROWS: tuple[tuple[int, str, str, str, float, str], ...] = (
    (2022, "cement", "Global", "co2_intensity", 620.0, "kg_CO2_per_t_cement"),
    (2022, "cement", "Global", "heat_consumption", 3300.0, "MJ_per_t_clinker"),
    (2022, "cement", "ASEAN", "co2_intensity", 680.0, "kg_CO2_per_t_cement"),
    (2022, "cement", "ASEAN", "heat_consumption", 3500.0, "MJ_per_t_clinker"),
    (2022, "cement", "Thailand", "co2_intensity", 670.0, "kg_CO2_per_t_cement"),
    (2030, "cement", "Global", "co2_intensity", 520.0, "kg_CO2_per_t_cement"),
    (2050, "cement", "Global", "co2_intensity", 100.0, "kg_CO2_per_t_cement"),
    (2050, "cement", "SCG", "co2_intensity", 0.0, "kg_CO2_per_t_cement"),
    (2030, "cement", "SCG", "co2_intensity", 650.0, "kg_CO2_per_t_cement"),
)
BENCHMARK_SECTOR = "cement"
BENCHMARK_YEAR = 2022
GLOBAL_REGION = "Global"
ASEAN_REGION = "ASEAN"
OWN_TARGET_REGION = "SCG"
OWN_TARGET_YEAR = 2030
TOP_BAND_FACTOR = 0.9
BOTTOM_BAND_FACTOR = 1.1

# Data-quality limits.
REASONABLE_RANGE = (200, 1200)
FRESHNESS_WARN_DAYS = 2
FRESHNESS_ERROR_DAYS = 5

# Country-emissions load.
OWID_MIN_YEAR = 2010

# Air-quality load: defaults for absent keys, and the source-side restriction.
OPENAQ_DEFAULT_LOCATION = "Rayong"
OPENAQ_DEFAULT_COUNTRY = "TH"
OPENAQ_DEFAULT_PARAMETER = ""
OPENAQ_DEFAULT_UNIT = "µg/m³"
OPENAQ_PARAMETERS = ("no2", "pm25", "so2")
OPENAQ_LOOKBACK_DAYS = 7

# Rolling windows, in reading days (rows), and the report windows, in calendar days.
ROLLING_SHORT_ROWS = 7
ROLLING_LONG_ROWS = 30
CHANGE_LAG_ROWS = 30
REPORT_WINDOWS_DAYS = {"30 days": 30, "90 days": 90, "180 days": 180, "1 year": 365}
DEFAULT_REPORT_DAYS = 90
REPORT_TIMEZONE = "Asia/Bangkok"
PIPELINE_LOG_ROWS = 20

# Display labels of the industry position; an unknown code passes through unchanged.
POSITION_LABELS = {
    "top_10pct": "🥇 Top 10%",
    "above_average": "⬆️ Above average",
    "below_average": "⬇️ Below average",
    "bottom_10pct": "⚠️ Bottom 10%",
}
BENCHMARK_CATEGORIES = ("SCG (current)", "ASEAN avg", "Global avg", "SCG 2030 target")

# ---------------------------------------------------------------------------------------
# This project's own names in the audit log: (dag_id, source) of each run record.

LOG_SENSOR_LOAD = ("ingest_sensor_readings", "kiln_feed")
LOG_COUNTRY_LOAD = ("ingest_external_sources", "owid_co2")
LOG_BENCHMARK_LOAD = ("ingest_external_sources", "iea_benchmarks")
LOG_AIR_QUALITY_LOAD = ("ingest_external_sources", "openaq")
LOG_DATA_TESTS = ("transform", "data_tests")
LOG_EXPORT = ("transform", "parquet_export")


@dataclass(frozen=True)
class PipelineConfig:
    """Run-level settings; defaults are the fixed values above."""

    baseline_intensity: int = BASELINE_INTENSITY
    target_2030: int = TARGET_2030
    target_2050: int = TARGET_2050
    near_target_factor: Decimal = NEAR_TARGET_FACTOR
    sensors: tuple[SensorSpec, ...] = SENSORS
    benchmark_rows: tuple[tuple[int, str, str, str, float, str], ...] = BENCHMARK_ROWS
    reasonable_range: tuple[int, int] = REASONABLE_RANGE
    as_of: dt.date = dt.date(2001, 10, 31)
    run_ts: dt.datetime = dt.datetime(2001, 11, 5, 0, 0, 0)
    report_days: int = DEFAULT_REPORT_DAYS

    @property
    def sensor_names(self) -> list[str]:
        return [s.name for s in self.sensors]


DEFAULT = PipelineConfig()
