"""Sources: Parquet tables with explicit schemas, landed CSV/JSON, and test-data adapters."""

from . import fixtures
from .readers import (read_air_quality_documents, read_air_quality_records, read_country_csv,
                      read_iea_benchmarks, read_openaq_readings, read_owid_emissions,
                      read_pipeline_log, read_sensor_readings)

__all__ = [
    "fixtures", "read_air_quality_documents", "read_air_quality_records", "read_country_csv",
    "read_iea_benchmarks", "read_openaq_readings", "read_owid_emissions", "read_pipeline_log",
    "read_sensor_readings",
]
