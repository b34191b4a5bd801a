"""Ingestion rules: anomaly flags, country-emission cleaning, benchmarks, air quality.

Fetching over HTTP is outside Spark: these functions start from landed files (or any
DataFrame of the same shape) and apply the loaders' rules as column expressions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..config import DEFAULT, PipelineConfig
from ..functions import out_of_limits
from ..functions.timeutil import ts_lit
from .joins import config_table

_LIMITS_SCHEMA = T.StructType([
    T.StructField("sensor", T.StringType(), False),
    T.StructField("lo", T.DoubleType(), False),
    T.StructField("hi", T.DoubleType(), False),
])


def sensor_limits(spark: SparkSession, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    return spark.createDataFrame([(s.name, s.lo, s.hi) for s in cfg.sensors], _LIMITS_SCHEMA)


def flag_anomalies(readings: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Flag readings outside their sensor's limits (strict ``<``/``>``).

    The limits table has one row per configured sensor (a known, small size), so it is
    broadcast: the readings are never shuffled.  A sensor without limits keeps its rows with a NULL flag.
    """
    limits = config_table(sensor_limits(readings.sparkSession, cfg))
    j = readings.join(limits, "sensor", "left")
    flag = out_of_limits(F.col("value"), F.col("lo"), F.col("hi"))
    cols = [c for c in readings.columns if c != "is_anomaly"]
    out = j.select(*cols, flag.alias("is_anomaly"))
    order = [c for c in ["reading_date", "plant_id", "sensor", "value", "unit_label", "is_anomaly",
                         "ingested_at"] if c in out.columns]
    return out.select(*order, *[c for c in out.columns if c not in order])


def clean_owid(landed: DataFrame, min_year: int = C.OWID_MIN_YEAR,
               run_ts: dt.datetime | None = None) -> DataFrame:
    """Country-emission rows in the raw table's shape.

    Columns are matched by name: ``co2`` becomes ``co2_total_mt``, absent measures are added
    as NULL, text is typed with ``try_cast`` (a malformed number is NULL, as a missing one).
    Rows before ``min_year`` or without year/country are dropped.
    """
    present = set(landed.columns)

    def num(name: str) -> F.Column:
        return F.col(name).try_cast("double") if name in present else F.lit(None).cast("double")

    year = F.col("year").try_cast("double").try_cast("int") if "year" in present else F.lit(None).cast("int")
    country = F.col("country").cast("string") if "country" in present else F.lit(None).cast("string")
    typed = landed.select(
        year.alias("year"), country.alias("country"),
        num("co2_per_capita").alias("co2_per_capita"),
        num("co2").alias("co2_total_mt"),
        num("cement_co2").alias("cement_co2"),
        num("energy_co2").alias("energy_co2"),
        ts_lit(run_ts).alias("ingested_at"),
    )
    return typed.where((F.col("year") >= min_year) & F.col("country").isNotNull())


def benchmark_rows(spark: SparkSession, cfg: PipelineConfig = DEFAULT,
                   run_ts: dt.datetime | None = None) -> DataFrame:
    """The published benchmark table (a fixed handful of rows), stamped with one load time."""
    schema = T.StructType([
        T.StructField("year", T.IntegerType(), False),
        T.StructField("sector", T.StringType(), False),
        T.StructField("region", T.StringType(), True),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("unit", T.StringType(), True),
    ])
    ts = run_ts or cfg.run_ts
    return spark.createDataFrame(list(cfg.benchmark_rows), schema).withColumn(
        "ingested_at", ts_lit(ts))


def parse_air_quality(records: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Typed air-quality rows from raw JSON records (column ``body``).

    ``date`` is either ``{"utc": "..."}`` or a plain string; its first 10 characters must
    parse as a ``y-M-d`` date, else the record is skipped.  Missing or null keys get the
    defaults; a missing/null value is 0, a value that is not a number skips the record.
    Each record is parsed once (``json_tuple`` returns every top-level field as text, an
    object as its JSON); only the small ``date`` object is parsed again for ``utc``.
    """
    fields = ["date", "location", "country", "parameter", "value", "unit"]
    # A ``_delivered_at`` column (a stream's file time) becomes the load time when present.
    carried = ["_delivered_at"] if "_delivered_at" in records.columns else []
    raw = records.select(F.json_tuple("body", *fields).alias(*[f"_{f}" for f in fields]), *carried)
    loaded_at = F.col("_delivered_at") if carried else ts_lit(run_ts)
    date_text = F.coalesce(F.get_json_object("_date", "$.utc"), F.col("_date"))
    day = F.try_to_date(F.substring(date_text, 1, 10), "yyyy-M-d")
    raw_value = F.col("_value")
    value = (F.when(raw_value.isNull() | (raw_value == ""), F.lit(0.0))
             .otherwise(raw_value.try_cast("double")))
    out = raw.select(
        day.alias("measurement_date"),
        F.coalesce("_location", F.lit(C.OPENAQ_DEFAULT_LOCATION)).alias("location"),
        F.coalesce("_country", F.lit(C.OPENAQ_DEFAULT_COUNTRY)).alias("country"),
        F.coalesce("_parameter", F.lit(C.OPENAQ_DEFAULT_PARAMETER)).alias("parameter"),
        value.alias("value"),
        F.coalesce("_unit", F.lit(C.OPENAQ_DEFAULT_UNIT)).alias("unit"),
        loaded_at.alias("ingested_at"),
    )
    return out.where(F.col("measurement_date").isNotNull() & F.col("value").isNotNull())


def recent_air_quality(parsed: DataFrame, as_of: dt.date,
                       parameters=C.OPENAQ_PARAMETERS,
                       lookback_days: int = C.OPENAQ_LOOKBACK_DAYS) -> DataFrame:
    """The source-side restriction of one fetch (station parameters, last N days), applied to
    landed rows.  Its page size has no meaning for landed data: every such row is kept."""
    d = F.col("measurement_date")
    return parsed.where(F.col("parameter").isin(list(parameters))
                        & (d >= F.date_sub(F.lit(as_of), lookback_days)))
