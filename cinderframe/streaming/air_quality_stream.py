"""Append-only air-quality ingestion with Structured Streaming.

Landed JSON records (one per line) are parsed with the batch loader's rules.  A micro-batch is
appended as a directory of its own, named by its rows (``sinks.append_load``): a batch that is
replayed, or that a batch run has loaded, doesn't append twice.  An empty micro-batch writes
nothing, as the batch rule requires.  The load time of a row is the delivery time of its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ingest, sinks
from .sensor_stream import MAX_FILE_AGE


def append_micro_batch(table_path: str):
    """The ``foreachBatch`` function: parse and append, named by the rows."""

    def append(batch: DataFrame, batch_id: int) -> None:
        sinks.append_load(ingest.parse_air_quality(batch), table_path)

    return append


def start_air_quality_ingest(spark: SparkSession, landing_dir: str, table_path: str,
                             checkpoint: str, available_now: bool = True) -> StreamingQuery:
    records = (spark.readStream.option("maxFileAge", MAX_FILE_AGE).text(landing_dir)
               .select(F.col("value").alias("body"),
                       F.col("_metadata.file_modification_time").alias("_delivered_at")))
    writer = (records.writeStream.foreachBatch(append_micro_batch(table_path))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str) -> None:
    """Append everything landed so far, then stop (one scheduled run)."""
    q = start_air_quality_ingest(spark, landing_dir, table_path, checkpoint, True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
