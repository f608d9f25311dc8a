"""Summarise stage timings from a Spark event log (no UI, no REST API).

Usage: python tools/stages.py <event-log file or folder> [top]
(for example after ``BENCH_EVENT_LOG=$(mktemp -d) python bench.py``)

Prints the slowest stages with their duration, task count and the first
line of their call site, and the total per job.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    """Lines of an event log: a plain or zstd file, or a rolling-log folder."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard

            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp, encoding="utf-8") as f:
                yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], {}
    stage_job = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
                jobs[ev["Job ID"]] = [ev.get("Submission Time"), None]
            elif kind == "SparkListenerJobEnd":
                if ev["Job ID"] in jobs:
                    jobs[ev["Job ID"]][1] = ev.get("Completion Time")
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                t0, t1 = info.get("Submission Time"), info.get("Completion Time")
                if t0 is None or t1 is None:
                    continue
                stages.append((t1 - t0, info["Stage ID"], info.get("Number of Tasks"),
                               (info.get("Stage Name") or "").split("\n")[0]))
    stages.sort(reverse=True)
    print(f"{'ms':>8} {'stage':>6} {'job':>5} {'tasks':>6}  name")
    for ms, sid, n, name in stages[:top]:
        print(f"{ms:>8} {sid:>6} {stage_job.get(sid, -1):>5} {n:>6}  {name[:80]}")
    total = sum(t1 - t0 for t0, t1 in jobs.values() if t0 and t1)
    print(f"jobs: {len(jobs)}, stages: {len(stages)}, job wall time: {total} ms")


if __name__ == "__main__":
    main()
