"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full into Spark's no-op sink (nothing is collected); the time
is the best of $BENCH_REPEAT runs after one warm-up query.  ``end_to_end_transform`` runs
the materialized staging -> scopes -> marts -> checks -> export chain on tables landed
from the same data; ``incremental_*`` re-deliver the last day and run the daily incremental
transform.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cinderframe.plans import pipeline  # noqa: E402
from cinderframe.sources import readers  # noqa: E402
from cinderframe.plans.queries import QUERIES  # noqa: E402
from cinderframe.session import local_session  # noqa: E402

HEADLINE = [
    "stg_sensor", "scope1_emissions", "scope2", "co2_intensity", "net_zero", "benchmark_gap",
    "dq_results", "rpt_kpi", "rpt_benchmark_latest", "rpt_trend", "stg_owid", "ingest_openaq",
    "flag_anomaly", "audit_summary", "export_co2_intensity", "load_replace_day",
    "stream_ingest_sensor", "ingest_owid",
]


def _run(spark, name: str, sf_dir: str) -> float:
    spark.sparkContext.setJobDescription(name)  # attributes stages in the event log
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="cinderframe-bench-")
    # BENCH_EVENT_LOG=1 writes Spark's event log into the scratch folder (stage and task times
    # without the web UI); summarize it with tools/stage_times.py.
    event_log = None
    if os.environ.get("BENCH_EVENT_LOG"):
        event_log = os.path.join(scratch, "events")
        os.makedirs(event_log, exist_ok=True)
        print(f"event log: {event_log}", file=sys.stderr)
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          checkpoint_dir=os.path.join(scratch, "ckpt"), event_log_dir=event_log)

    _run(spark, "co2_intensity", sf_dir)  # warm-up (JIT, class loading)
    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = round(min(_run(spark, name, sf_dir) for _ in range(repeat)), 3)

    wh = pipeline.Warehouse(os.path.join(scratch, "warehouse"))
    spark.sparkContext.setJobDescription("end_to_end_ingest")
    t = time.perf_counter()
    pipeline.land_fixtures(spark, sf_dir, wh)
    times["end_to_end_ingest"] = round(time.perf_counter() - t, 3)
    spark.sparkContext.setJobDescription("end_to_end_transform")
    t = time.perf_counter()
    pipeline.transform(spark, wh, pipeline.fixtures.RUN_TS)
    times["end_to_end_transform"] = round(time.perf_counter() - t, 3)

    # A daily run: the last reading day is delivered again (replaced in place), then the
    # transform re-reads only that day and rebuilds the plant-day sized tables.
    raw = readers.read_sensor_readings(spark, wh.path("raw_sensor_readings"))
    last_day = raw.agg(F.max("reading_date")).first()[0]
    batch = raw.where(F.col("reading_date") == F.lit(last_day)).drop("is_anomaly", "ingested_at")
    spark.sparkContext.setJobDescription("incremental_load")
    t = time.perf_counter()
    pipeline.ingest_sensor_batch(spark, wh, batch, pipeline.fixtures.RUN_TS)
    times["incremental_load"] = round(time.perf_counter() - t, 3)
    spark.sparkContext.setJobDescription("incremental_transform")
    t = time.perf_counter()
    pipeline.transform(spark, wh, pipeline.fixtures.RUN_TS, since=last_day)
    times["incremental_transform"] = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
