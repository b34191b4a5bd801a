"""Summarize stage times from a Spark event log (no UI needed).

    python tools/stage_times.py <event-log-dir-or-file> [top_n]

Prints the slowest stages (duration, tasks, name) and the total per job group, read from
``SparkListenerStageCompleted`` / ``SparkListenerJobStart`` events.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _files(path: str) -> list[str]:
    """Event-log files under ``path`` (Spark 4 rolls them into ``eventlog_v2_*`` folders)."""
    if os.path.isfile(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in names if not n.startswith((".", "appstatus"))]
    return sorted(out)


def _lines(fn: str):
    """JSON lines of one event-log file (plain or zstd-compressed, Spark 4's default)."""
    if fn.endswith(".zstd"):
        import io

        import zstandard
        with open(fn, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(fn, encoding="utf-8") as f:
            yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, desc_of_stage = [], {}
    for fn in _files(path):
        for line in _lines(fn):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                desc = props.get("spark.job.description") or props.get("callSite.short") or "?"
                for sid in ev.get("Stage IDs", []):
                    desc_of_stage[sid] = desc
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    stages.append((end - start, info["Stage ID"], info.get("Number of Tasks"),
                                   info.get("Stage Name", "")[:70]))
    stages.sort(reverse=True)
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6}  {'job':<24} stage")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms:>8} {sid:>6} {tasks:>6}  {desc_of_stage.get(sid, '?')[:24]:<24} {name[:40]}")
    per_job = defaultdict(int)
    for ms, sid, _, _ in stages:
        per_job[desc_of_stage.get(sid, "?")[:60]] += ms
    print("\nstage time by job call site:")
    for desc, ms in sorted(per_job.items(), key=lambda kv: -kv[1])[:top]:
        print(f"{ms:>8}  {desc}")


if __name__ == "__main__":
    main()
