"""Measure registered queries: wall time, rows read, shuffle and spill per query.

``python -m workload.measure SF_DIR [name ...]`` prints a markdown table. The
numbers come from Spark's own event log.
"""

from __future__ import annotations

import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from thumbwheel.session import local_session
from workload.queries import REGISTRY


def task_totals(log_dir: str) -> dict[str, dict[str, int]]:
    """Sums of task metrics per job group."""
    group_of_stage: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for path in sorted(p for p in Path(log_dir).rglob("*") if p.is_file() and "appstatus" not in p.name):
        for line in path.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                group_of_stage.update({s: group for s in event["Stage IDs"]})
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                m, t = event["Task Metrics"], totals[group_of_stage.get(event["Stage ID"])]
                t["rows"] += m["Input Metrics"]["Records Read"]
                t["shuffle"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                t["spill"] += m["Disk Bytes Spilled"]
                t["longest_ms"] = max(t["longest_ms"], m["Executor Run Time"])
    return totals


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    logs = tempfile.mkdtemp(prefix="thumbwheel-events-")
    spark = local_session(
        8,
        settings={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{logs}",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for i in range(4):
            spark.sparkContext.setJobGroup(f"{name}/{i}", name)
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = statistics.median(runs[1:])
    spark.stop()
    totals = task_totals(logs)
    print("| query key | sf | rows read | median s | shuffle MB | spill MB | longest task s |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    sf = Path(sf_dir).name.removeprefix("sf")
    for name in names:
        t = totals[f"{name}/3"]
        print(
            f"| {name} | {sf} | {t['rows']:,} | {seconds[name]:.2f} | {t['shuffle'] / 1e6:.2f} "
            f"| {t['spill'] / 1e6:.2f} | {t['longest_ms'] / 1000:.2f} |"
        )


if __name__ == "__main__":
    main()
