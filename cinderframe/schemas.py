"""Explicit schemas of the raw tables (no schema inference on the hot path)."""

from pyspark.sql import types as T

RAW_SENSOR_READINGS = T.StructType([
    T.StructField("reading_date", T.DateType(), False),
    T.StructField("plant_id", T.StringType(), False),
    T.StructField("sensor", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
    T.StructField("unit_label", T.StringType(), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

# As stored: with the month of the reading, a directory of the table.
STORED_SENSOR_READINGS = T.StructType([
    *RAW_SENSOR_READINGS.fields, T.StructField("reading_month", T.StringType(), False)])

# The last reading days of each plant before each month, but for the month (a directory).
WINDOW_STATE = T.StructType([
    T.StructField("reading_date", T.DateType(), True),
    T.StructField("plant_id", T.StringType(), True),
    T.StructField("scope1_intensity_avg", T.DoubleType(), True),
])

RAW_OWID_EMISSIONS = T.StructType([
    T.StructField("year", T.IntegerType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("co2_per_capita", T.DoubleType(), True),
    T.StructField("co2_total_mt", T.DoubleType(), True),
    T.StructField("cement_co2", T.DoubleType(), True),
    T.StructField("energy_co2", T.DoubleType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

RAW_IEA_BENCHMARKS = T.StructType([
    T.StructField("year", T.IntegerType(), False),
    T.StructField("sector", T.StringType(), False),
    T.StructField("region", T.StringType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

RAW_OPENAQ_READINGS = T.StructType([
    T.StructField("measurement_date", T.DateType(), False),
    T.StructField("location", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("parameter", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
])

PIPELINE_LOG = T.StructType([
    T.StructField("run_at", T.TimestampType(), True),
    T.StructField("dag_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("rows_loaded", T.IntegerType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("message", T.StringType(), True),
])

# Raw tables and their NOT NULL columns, as declared for the relational store.
NOT_NULL_COLUMNS = {
    "raw_sensor_readings": ["reading_date", "plant_id", "sensor", "value"],
    "raw_owid_emissions": ["year", "country"],
    "raw_iea_benchmarks": ["year", "sector", "metric"],
    "raw_openaq_readings": ["measurement_date", "parameter"],
    "pipeline_log": ["dag_id", "source", "status"],
}
