"""Slowest stages from a Spark event log (plain or zstd-compressed).

Usage: python tools/stage_times.py <event-log dir or file> [top_n]

Enable the log with spark.eventLog.enabled=true and spark.eventLog.dir=<a
scratch folder> (bench.py does so when BENCH_EVENTLOG_DIR is set).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh),
                                        encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    target = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    files = [target] if os.path.isfile(target) else [
        p for p in glob.glob(os.path.join(target, "**", "*"), recursive=True)
        if os.path.isfile(p) and ("events" in os.path.basename(p) or p.endswith(".zstd")
                                  or "local-" in os.path.basename(p))
        and not os.path.basename(p).startswith("appstatus")]
    stages, job_of, job_desc = {}, {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                job_desc[e["Job ID"]] = (props.get("spark.job.description")
                                         or props.get("callSite.short") or "")[:60]
                for s in e.get("Stage IDs", []):
                    job_of[s] = e["Job ID"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                          si["Number of Tasks"], si["Stage Name"][:60])
    total = sum(v[0] for v in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    for sid, (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        job = job_of.get(sid)
        print(f"stage {sid:5d} {ms / 1000:7.2f} s {tasks:6d} tasks  {name} | job {job} "
              f"{job_desc.get(job, '')}")


if __name__ == "__main__":
    main()
