"""Adapters that derive the pipeline's inputs from the driver's star-schema tables.

The test data has no emission tables, so each raw input is a deterministic projection of a
driver table (one sensor per line number, one plant per supplier residue, one country-year
per nation and order year, one air-quality record and one log row per event).  The same
definitions are written as SQL in ``plans/oracle.py``; the two must stay in step.

These are plain projections and one aggregate, so they scale with the driver tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators.joins import config_table

# Test data: (base, span) of each configured sensor.  Line number n reads sensor n; its value is
# base + span * (quantity - 25) / 25, so quantities 1..50 sweep base +/- span.
SWEEPS = ((680.0, 150.0), (750.0, 100.0), (10.2, 6.0), (380.0, 450.0), (12.0, 15.0), (45.0, 60.0),
          (2.5, 2.0))
SENSOR_FIXTURE = tuple((n, s.name, base, span, s.lo, s.hi, s.unit)
                       for n, (s, (base, span)) in enumerate(zip(C.SENSORS, SWEEPS), 1))
_SPEC_SCHEMA = T.StructType([
    T.StructField("n", T.IntegerType(), False),
    T.StructField("sensor", T.StringType(), False),
    T.StructField("base", T.DoubleType(), False),
    T.StructField("span", T.DoubleType(), False),
    T.StructField("lo", T.DoubleType(), False),
    T.StructField("hi", T.DoubleType(), False),
    T.StructField("unit_label", T.StringType(), False),
])

PLANTS = 10
AS_OF = dt.date(2001, 10, 31)
RUN_TS = dt.datetime(2001, 11, 5, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_fixture_values(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """Sensor readings without the anomaly flag (the shape a kiln feed delivers)."""
    spec = spark.createDataFrame(list(SENSOR_FIXTURE), _SPEC_SCHEMA)
    li = lineitem.select("l_shipdate", "l_suppkey", "l_linenumber", "l_quantity")
    joined = li.join(config_table(spec), li["l_linenumber"] == spec["n"])
    value = F.col("base") + F.col("span") * ((F.col("l_quantity") - F.lit(25.0)) / F.lit(25.0))
    return joined.select(
        F.col("l_shipdate").cast("date").alias("reading_date"),
        F.concat(F.lit("PLANT_"), F.lpad((F.col("l_suppkey") % PLANTS).cast("string"), 2, "0"))
        .alias("plant_id"),
        F.col("sensor"),
        value.alias("value"),
        F.col("unit_label"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        F.col("lo"), F.col("hi"),
    )


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_sensor_readings`` derived from ``lineitem``."""
    base = sensor_fixture_values(spark, table(spark, sf_dir, "lineitem"))
    return base.select(
        "reading_date", "plant_id", "sensor", "value", "unit_label",
        ((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))).alias("is_anomaly"),
        "ingested_at",
    )


def unflagged_sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sensor_fixture_values(spark, table(spark, sf_dir, "lineitem"))
    return base.select("reading_date", "plant_id", "sensor", "value", "unit_label", "ingested_at")


def owid_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country-year emission rows derived from orders x customer x nation."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    j = (orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    g = (j.groupBy((F.year("o_orderdate") + 14).alias("year"), F.col("n_name").alias("country"),
                   "n_nationkey")
         .agg(F.sum(price).alias("total"), F.count(F.lit(1)).alias("n"),
              F.sum(F.when(F.col("o_orderstatus") == "F", price).otherwise(F.lit(0))).alias("f"),
              F.sum(F.when(F.col("o_orderstatus") == "O", price).otherwise(F.lit(0))).alias("o")))
    key = F.col("n_nationkey")
    return g.select(
        F.col("year").cast("int").alias("year"),
        "country",
        F.when(key % 11 == 5, F.lit(None).cast("double"))
        .when(key % 11 == 6, F.lit(0.0))
        .otherwise(F.col("total").cast("double") / 1e6).alias("co2_total_mt"),
        (F.col("n").cast("double") / 10.0).alias("co2_per_capita"),
        F.when(key % 7 == 3, F.lit(None).cast("double"))
        .otherwise(F.col("f").cast("double") / 1e6).alias("cement_co2"),
        (F.col("o").cast("double") / 1e6).alias("energy_co2"),
    )


def benchmark_metrics(spark: SparkSession, sf_dir: str, run_ts: dt.datetime = RUN_TS) -> DataFrame:
    """Benchmark-table rows derived from the country-year figures: one row per (country-year,
    metric), listed under two sectors, so the benchmark pivot runs over data that grows with
    the driver tables."""
    o = owid_emissions(spark, sf_dir)
    long = o.unpivot(["year", "country"], ["co2_total_mt", "energy_co2", "co2_per_capita"],
                     "measure", "value")
    metric = (F.when(F.col("measure") == "co2_total_mt", "co2_intensity")
              .when(F.col("measure") == "energy_co2", "heat_consumption")
              .otherwise("per_capita"))
    rows = long.select("year", F.col("country").alias("region"), metric.alias("metric"), "value",
                       F.lit("unit").alias("unit"))
    sectors = F.explode(F.array(F.lit("cement"), F.lit("steel"))).alias("sector")
    return rows.select("year", sectors, "region", "metric", "value", "unit",
                       F.lit(run_ts.isoformat(sep=" ")).cast("timestamp").alias("ingested_at"))


def owid_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows shaped like the published CSV (``co2`` instead of ``co2_total_mt``,
    plus a column the loader ignores)."""
    o = owid_emissions(spark, sf_dir)
    return o.select("country", "year", F.col("co2_total_mt").alias("co2"), "co2_per_capita",
                    "cement_co2", "energy_co2", F.lit("x").alias("iso_code"))


def air_quality_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per event, in five shapes (nested date, plain date, bad date,
    missing location/country, null value)."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id") % 5
    day = F.col("ts").cast("date").cast("string")
    date_part = (F.when(k == 1, F.concat(F.lit('"'), day, F.lit('"')))
                 .when(k == 2, F.lit('"not-a-date"'))
                 .otherwise(F.concat(F.lit('{"utc":"'), day, F.lit('T00:00:00Z"}'))))
    loc_part = (F.when(k == 3, F.lit(""))
                .otherwise(F.concat(F.lit(',"location":"ST_'), (F.col("user_id") % 7).cast("string"),
                                    F.lit('","country":"TH"'))))
    val_part = (F.when(k == 4, F.lit(',"value":null'))
                .otherwise(F.concat(F.lit(',"value":'),
                                    F.col("value").cast("decimal(10,2)").cast("string"))))
    body = F.concat(F.lit('{"date":'), date_part, loc_part, F.lit(',"parameter":"'),
                    F.col("event_type"), F.lit('"'), val_part, F.lit("}"))
    return ev.select("event_id", body.alias("body"))


def pipeline_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records derived from events."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        # the event's wall clock as an instant in UTC, whatever the session's time zone
        F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("run_at"),
        F.when(F.col("event_type").isin("click", "view"), "ingest_sensor_readings")
        .otherwise("transform").alias("dag_id"),
        F.col("event_type").alias("source"),
        F.floor("value").cast("int").alias("rows_loaded"),
        F.when(F.col("event_type") == "error", "warning").otherwise("success").alias("status"),
        F.col("props").alias("message"),
    )


def air_quality_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as API responses: ``{"results": [...]}``, 50 events' records each."""
    records = air_quality_bodies(spark, sf_dir)
    page = records.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(
        F.array_join(F.sort_array(F.collect_list("body")), ",").alias("records"))
    return page.select(F.concat(F.lit('{"meta":{"page":'), F.col("page").cast("string"),
                                F.lit('},"results":['), F.col("records"), F.lit("]}")).alias("document"))


def metered_scope2(estimated: DataFrame) -> DataFrame:
    """Scope 2 as a meter would deliver it: it varies and misses every third day of a month."""
    return (estimated.where(F.dayofmonth("reading_date") % 3 != 0)
            .withColumn("scope2_intensity_kg_per_t", 40.0 + F.col("reading_count") * 2.5))


def faulty(df: DataFrame, column: str, where: F.Column, value=None) -> DataFrame:
    """``df`` with ``column`` replaced (by NULL) in some rows: input for the data tests."""
    replaced = F.when(where, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
    return df.withColumn(column, replaced)
