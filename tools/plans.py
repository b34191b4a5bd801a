"""Summarize the physical plans of the headline queries into docs/PLANS.md.

    python tools/plans.py [sf_dir]

For each query: shuffles (Exchange), join strategies, scans with their pushed filters and
read schema, and the number of whole-stage-codegen subtrees, followed by the full
``explain("formatted")`` text.  Plans are taken before execution (AQE may still coalesce
partitions or turn a join into a broadcast at run time).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cinderframe.operators import scopes, staging  # noqa: E402
from cinderframe.plans import pipeline  # noqa: E402
from cinderframe.plans.queries import QUERIES, RUN_TS  # noqa: E402
from cinderframe.session import local_session  # noqa: E402
from cinderframe.sources import readers  # noqa: E402

HEADLINE = ["co2_intensity", "scope2", "benchmark_gap", "net_zero", "rpt_latest", "rpt_kpi",
            "rpt_pipeline_log", "dq_results", "flag_anomaly", "ingest_openaq"]


def plan_text(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarize(text: str) -> list[str]:
    head = text.split("\n\n")[0]
    ops = re.findall(r"[+:-]*\s*([A-Za-z]+(?:Join|Exchange|Aggregate|Window|Scan parquet|Scan|Sort|"
                     r"TakeOrderedAndProject|Generate|CollectMetrics)\b)", head)
    shuffles = len(re.findall(r"(?<!Broadcast)Exchange \(", head))
    out = [
        f"- shuffles (Exchange, excl. broadcast): {shuffles}",
        f"- broadcast exchanges: {head.count('BroadcastExchange')}",
        f"- joins: {', '.join(sorted(set(o for o in ops if o.endswith('Join')))) or 'none'}",
    ]
    for m in re.finditer(r"\(\d+\) Scan parquet[^\n]*\n(?:.*\n)*?(?=\n\(|\Z)", text):
        block = m.group(0)
        loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
        pushed = re.search(r"PushedFilters: (\[.*\])", block)
        schema = re.search(r"ReadSchema: (.*)", block)
        name = os.path.basename(loc.group(1).split(",")[0]) if loc else "?"
        out.append(f"- scan `{name}`: pushed {pushed.group(1) if pushed else '[]'}; "
                   f"read `{schema.group(1) if schema else '?'}`")
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="cinderframe-plans-")
    spark = local_session(checkpoint_dir=os.path.join(scratch, "ckpt"))
    sections = []
    for name in HEADLINE:
        text = plan_text(QUERIES[name](spark, sf))
        sections.append((name, text))
    wh = pipeline.Warehouse(os.path.join(scratch, "wh"))
    pipeline.ingest_sensor_batch(spark, wh, pipeline.fixtures.unflagged_sensor_readings(spark, sf), RUN_TS)
    raw = readers.read_sensor_readings(spark, wh.path("raw_sensor_readings"))
    sections.append(("pipeline: plant-day aggregate over the stored raw table",
                     plan_text(scopes.daily_plant_readings(staging.stg_sensor_readings(raw)))))
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plans.py` on `{os.path.basename(sf)}` (plans before execution; "
             "AQE may coalesce partitions at run time).", ""]
    for name, text in sections:
        lines += [f"## {name}", ""] + summarize(text) + ["", "<details><summary>plan</summary>", "",
                                                         "```", text.strip(), "```", "", "</details>", ""]
    os.makedirs("docs", exist_ok=True)
    with open("docs/PLANS.md", "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
