"""Summarise Spark event logs: per SQL execution, its jobs and stage times.

Usage: python scripts/stage_times.py <event log dir>
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def lines(path: str):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(root: str) -> None:
    files = sorted(f for f in glob.glob(f"{root}/**/*", recursive=True)
                   if "events_" in f or f.endswith(".zstd"))
    stages, jobs, sql = {}, {}, {}
    for f in files:
        for line in lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                          si["Number of Tasks"])
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], None,
                                     e.get("Properties", {}).get("spark.sql.execution.id")]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][2] = e["Completion Time"]
            elif ev.endswith("SparkListenerSQLExecutionStart"):
                sql[e["executionId"]] = [e["time"], None, e.get("description", "")[:40]]
            elif ev.endswith("SparkListenerSQLExecutionEnd"):
                sql[e["executionId"]][1] = e["time"]
    for x, (s, c, d) in sorted(sql.items()):
        print(f"sql {x}: {(c or s) - s} ms {d}")
        for j, (js, st, jc, xid) in sorted(jobs.items()):
            if str(xid) == str(x):
                ran = [(sid, stages[sid]) for sid in st if sid in stages]
                print(f"   job {j}: +{js - s} ms, {(jc or js) - js} ms, stages (ms, tasks) {ran}")


if __name__ == "__main__":
    main(sys.argv[1])
