"""Summarise a Spark event log: wall time per job group (query) and the
slowest stages, from the JSON lines Spark writes with spark.eventLog.enabled.

    python tools/stage_times.py <event-log folder or file> [--top 5]
"""

from __future__ import annotations

import argparse
import json
from collections import defaultdict
from pathlib import Path


def events(path: Path):
    # Spark 4 writes rolling logs: <dir>/eventlog_v2_<app>/events_<n>_<app>
    if path.is_dir():
        files = sorted(p for p in path.rglob("*") if p.is_file() and p.name.startswith(("events", "local-", "app-")))
    else:
        files = [path]
    for f in files:
        if f.suffix == ".zstd":  # Spark's default event log codec
            import io

            import zstandard

            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        else:
            with open(f) as fh:
                for line in fh:
                    yield json.loads(line)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=5)
    a = ap.parse_args()
    job_group, job_time, stage_job = {}, {}, {}
    stage_info = {}
    for e in events(Path(a.path)):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            job_group[e["Job ID"]] = props.get("spark.jobGroup.id", "?")
            job_time[e["Job ID"]] = [e["Submission Time"], None]
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = e["Job ID"]
        elif kind == "SparkListenerJobEnd":
            job_time[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stage_info[info["Stage ID"]] = (
                    info["Completion Time"] - info["Submission Time"],
                    info["Number of Tasks"],
                    info["Stage Name"],
                )
    per_group = defaultdict(lambda: [0, 0])
    for jid, (start, end) in job_time.items():
        if end is not None:
            g = per_group[job_group.get(jid, "?")]
            g[0] += end - start
            g[1] += 1
    print("query                      jobs   job-ms")
    for g, (ms, n) in sorted(per_group.items(), key=lambda x: -x[1][0]):
        print(f"{g:26s} {n:5d} {ms:8d}")
    by_group = defaultdict(list)
    for sid, (ms, tasks, name) in stage_info.items():
        by_group[job_group.get(stage_job.get(sid), "?")].append((ms, tasks, name))
    for g, stages in by_group.items():
        print(f"\n{g}: slowest stages")
        for ms, tasks, name in sorted(stages, reverse=True)[: a.top]:
            print(f"  {ms:7d} ms  {tasks:5d} tasks  {name[:70]}")


if __name__ == "__main__":
    main()
