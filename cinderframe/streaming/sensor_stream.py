"""Incremental sensor ingestion with Structured Streaming.

A delivery is a folder ``delivery=<id>`` of Parquet files in the landing directory; ids sort by
age (a time stamp, for example).  A file-source stream notices new files (its checkpoint records
which were seen) and every micro-batch loads the plant-days that its files hold, *as a whole*:
a plant-day that lands over several files and triggers is loaded again when more of it appears.
Loading flags anomalies, then replaces these plant-days, which is idempotent, so a micro-batch
that is replayed after a failure writes the same result again.

Constraints come before keys: a micro-batch with a NULL in a NOT NULL column of the raw table
fails as a whole, before its rows are filtered or joined by anything, and loads nothing.

Where several deliveries carry the same plant-day, the newest of *all landed* ones wins, with all
its files, in whatever order the files arrive: a late file of an older delivery doesn't undo a
correction.  Which files those are is kept in an index beside the table: a row for each
plant-day and file of its newest delivery.  A micro-batch adds the plant-days of its own files and
then reads the files that the index names for them, and no others, however much has landed before.
Files outside a delivery folder load too, as one delivery that is older than any named one.
``trigger(availableNow)`` processes everything that has landed and stops, which is how a
scheduled run uses it; without it the same query runs continuously.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import DEFAULT, PipelineConfig
from ..operators import ingest, sinks

LANDED_SENSOR_SCHEMA = T.StructType([
    T.StructField("reading_date", T.DateType(), True),
    T.StructField("plant_id", T.StringType(), True),
    T.StructField("sensor", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit_label", T.StringType(), True),
])
_KEYS = ["reading_date", "plant_id"]


DELIVERY, FILE = "delivery", "file"
# Index rows of so many micro-batches are rewritten as one, without those of older deliveries.
INDEXED_BATCHES = 50
# A file is new however late it lands: by default a stream skips files a week older than the newest.
MAX_FILE_AGE = "36500d"


def newest_delivery(rows: DataFrame) -> DataFrame:
    """The rows of the newest delivery of each plant-day.

    The newest id per plant-day is a partial aggregate; rows are then kept by an equi-join, so
    no plant-day is gathered into one task (AQE broadcasts the small side or splits a hot key).
    """
    pick = rows.groupBy(*_KEYS).agg(F.max(DELIVERY).alias(DELIVERY))
    return rows.join(pick, [*_KEYS, DELIVERY], "left_semi")


def _landed_columns(rows: DataFrame) -> DataFrame:
    """With the delivery (out of the file's path), the file and the time it was landed."""
    # The path is a URI (escaped), and the folder's name in it has the escapes of a partition value.
    folder = F.regexp_extract("_metadata.file_path", rf"/{DELIVERY}=([^/]*)/[^/]*$", 1)
    for _ in range(2):
        folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return rows.select(*LANDED_SENSOR_SCHEMA.names, folder.alias(DELIVERY), F.col("_metadata.file_path").alias(FILE),
                       F.col("_metadata.file_modification_time").alias("ingested_at"))


def landed(reader, landing_dir: str) -> DataFrame:
    """Landed rows with their delivery, their file and the time it was landed.

    The delivery is read from the file's path (empty outside a delivery folder): partition
    discovery would leave out files beside the folders."""
    return _landed_columns(reader.schema(LANDED_SENSOR_SCHEMA).option("recursiveFileLookup", True)
                           .parquet(landing_dir))


def check_not_null(batch: DataFrame) -> dict:
    """First and last day of a micro-batch; raises if a NOT NULL column of the raw table has a NULL."""
    columns = schemas.NOT_NULL_COLUMNS["raw_sensor_readings"]
    found = batch.agg(F.min("reading_date").alias("first"), F.max("reading_date").alias("last"),
                      *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in columns]).first().asDict()
    missing = [f"raw_sensor_readings.{c} ({found[f'no_{c}']} rows)" for c in columns if found[f"no_{c}"]]
    if missing:
        raise ValueError(f"NOT NULL violated: {', '.join(missing)}")
    return found


class DeliveryIndex:
    """The files that hold each plant-day of its newest landed delivery.

    A Parquet table (reading_date, plant_id, delivery, file) with a folder per micro-batch, sorted by
    day, which a replay overwrites.  Now and then one folder takes in all earlier ones and
    drops what newer deliveries have replaced, so the index follows the plant-days, not the history."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self, batch_ids: list[int] | None = None) -> DataFrame:
        ids = self.batches() if batch_ids is None else batch_ids
        schema = f"reading_date date, plant_id string, {DELIVERY} string, {FILE} string"
        if not ids:
            return self.spark.createDataFrame([], schema)
        parts = [f"{self.path}/batch_id={i}" for i in ids]
        return self.spark.read.schema(schema).parquet(*parts)

    def batches(self) -> list[int]:
        """Ids of the folders that hold rows; one that takes in earlier ones stands for them."""
        ids, whole = [], -1
        for name in sinks.list_names(self.spark, self.path):
            kind, _, number = name.partition("=")
            if kind == "batch_id" and sinks.path_exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
                ids.append(int(number))
                if sinks.path_exists(self.spark, f"{self.path}/_whole/{number}"):
                    whole = max(whole, int(number))
        return sorted(i for i in ids if i >= whole)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Record a micro-batch: its (reading_date, plant_id, delivery, file), distinct."""
        before = [i for i in self.batches() if i != batch_id]
        merge = len(before) >= INDEXED_BATCHES
        found = rows.select(*_KEYS, DELIVERY, FILE).distinct()
        if merge:
            found = newest_delivery(found.unionByName(self._rows(before)).distinct())
        (found.hint("rebalance").sortWithinPartitions(*_KEYS)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/batch_id={batch_id}"))
        if merge:  # from this mark on the earlier folders don't count; then they go
            sinks.create_empty(self.spark, f"{self.path}/_whole/{batch_id}")
            for i in before:
                sinks.remove_path(self.spark, f"{self.path}/batch_id={i}")

    def newest(self, days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
        """(reading_date, plant_id, delivery, file) of the newest delivery of the plant-days ``days``, which
        lie between two dates: row groups of other days are skipped."""
        near = self._rows().where(F.col("reading_date").between(F.lit(first), F.lit(last)))
        return newest_delivery(near.join(days, _KEYS, "left_semi"))


def delivered_rows(spark: SparkSession, picked: DataFrame) -> DataFrame:
    """The landed rows of ``picked`` (reading_date, plant_id, delivery, file), out of its files alone.

    The names of these files are what the driver's file listing would hold."""
    files = [r[0] for r in picked.select(FILE).distinct().collect()]
    return landed_files(spark, files).join(picked.drop(FILE), [*_KEYS, DELIVERY], "left_semi")


def landed_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """The rows of landed files, named as ``_metadata.file_path`` names them."""
    return _landed_columns(spark.read.schema(LANDED_SENSOR_SCHEMA).parquet(*map(sinks.plain_path, files)))


def load_micro_batch(landing_dir: str, table_path: str, cfg: PipelineConfig = DEFAULT):
    """The ``foreachBatch`` function: constraints -> index -> newest landed delivery -> flag -> replace."""

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        range_ = check_not_null(batch)
        if range_["first"] is None:
            return  # files without rows
        index = DeliveryIndex(spark, f"{table_path}_deliveries")
        seen = batch
        if not sinks.path_exists(spark, index.path) and sinks.path_exists(spark, table_path):
            seen = landed(spark.read, landing_dir)  # a table from before the index: all files, once
        index.add(seen, batch_id)
        days = index._rows([batch_id]).select(*_KEYS).distinct() if seen is batch else batch.select(*_KEYS).distinct()
        rows = delivered_rows(spark, index.newest(days, range_["first"], range_["last"]))
        run_ts = dt.datetime(1970, 1, 1)  # only used where ingested_at is NULL (never here)
        sinks.replace_plant_days(ingest.flag_anomalies(rows.drop(DELIVERY, FILE), cfg), table_path, run_ts)

    return load


def sensor_stream(spark: SparkSession, landing_dir: str) -> DataFrame:
    return landed(spark.readStream.option("maxFileAge", MAX_FILE_AGE), landing_dir)


def start_sensor_ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                        available_now: bool = True, cfg: PipelineConfig = DEFAULT) -> StreamingQuery:
    """Start the ingestion stream; the checkpoint must be on shared storage."""
    writer = (sensor_stream(spark, landing_dir).writeStream
              .foreachBatch(load_micro_batch(landing_dir, table_path, cfg))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                  cfg: PipelineConfig = DEFAULT) -> None:
    """Process everything landed so far, then stop (one scheduled run)."""
    q = start_sensor_ingest(spark, landing_dir, table_path, checkpoint, True, cfg)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
