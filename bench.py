"""Time every query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

BENCH_ONLY=part,part limits the queries; BENCH_RUNS sets the number of timed runs (the median counts).
With BENCH_EVENT_DIR, Spark writes its event log there and the shuffle bytes of each query are added.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from tallyloom.plans.registry import QUERIES, runner
from tallyloom.session import local_session


def timed(plan, spark, folder: str) -> float:
    start = time.perf_counter()
    plan(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffle_bytes(log_folder: str) -> dict[str, int]:
    """Bytes written to shuffles per job group, from the event log."""
    group_of: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in sorted(p for p in Path(log_folder).rglob("*") if p.is_file() and not p.name.startswith((".", "appstatus"))):
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                group_of.update({s: group for s in event["Stage IDs"] if group})
            elif event["Event"] == "SparkListenerTaskEnd" and event["Stage ID"] in group_of:
                metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                name = group_of[event["Stage ID"]]
                written[name] = written.get(name, 0) + metrics.get("Shuffle Bytes Written", 0)
    return written


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [p for p in os.environ.get("BENCH_ONLY", "").split(",") if p]
    events = os.environ.get("BENCH_EVENT_DIR")
    logging = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false"} if events else {}
    spark = local_session(cpus, shuffle_partitions=cpus, **logging)
    for name in ("diner_q05_favourites", "retail_top_countries"):
        timed(runner(QUERIES[name]), spark, folder)
    seconds: dict[str, float] = {}
    for name, plan in QUERIES.items():
        if only and not any(p in name for p in only):
            continue
        spark.sparkContext.setJobGroup(name, name)
        seconds[name] = round(statistics.median(timed(runner(plan), spark, folder) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}
    if events:
        result["shuffle_bytes"] = {name: n // runs for name, n in shuffle_bytes(events).items() if name in seconds}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
