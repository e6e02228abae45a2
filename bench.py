"""Benchmark: the layered run and the dashboard queries on one input size.

Each step is timed in dependency order; every step reads the tables that the
earlier steps wrote (as the layered run does), so a step's time is its own
work, not its upstream's.  Dashboards run over the written gold tables.  The
whole is run several times and the median of each step is reported, with the
rows it wrote and the bytes it shuffled (from Spark's event log).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.plans import dashboard  # noqa: E402
from larder.plans.lineage import Lineage  # noqa: E402
from larder.session import local_session  # noqa: E402

STEPS = [
    "raw", "dim_aisle", "dim_department", "dim_product", "quarantine", "model_labels", "dim_product_ai",
    "fact_orders", "fact", "quarantine_lines", "demand", "reorder", "inventory", "pairs", "stockout", "overstock",
]


def one_run(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, tuple[float, float]], dict[str, int]]:
    """(seconds, begin and end, rows written) by step."""
    times: dict[str, float] = {}
    spans: dict[str, tuple[float, float]] = {}
    rows: dict[str, int] = {}
    lineage = Lineage(spark, sf_dir)

    def timed(name: str, work):
        t0 = time.time()
        out = work()
        spans[name] = (t0, time.time())
        times[name] = spans[name][1] - t0
        return out

    for step in STEPS:
        if step == "raw":  # the raw tables are written when built
            rows[step] = timed(step, lambda: lineage.raw).order_products_prior.count()
        else:
            rows[step] = timed(step, lambda step=step: getattr(lineage, step)).count()
    for name, (source, _) in dashboard.DASHBOARDS.items():
        lineage.table(source)
        rows[name] = len(timed(name, lambda name=name: dashboard.dashboard_query(name, lineage.table).collect()))
    return times, spans, rows


def shuffled(log_dir: str, spans: dict[str, tuple[float, float]]) -> dict[str, int]:
    """Bytes that tasks launched within each step wrote to shuffles."""
    total: dict[str, int] = defaultdict(int)
    for path in Path(log_dir).rglob("*"):
        if not path.is_file():
            continue
        for line in path.open(errors="replace"):
            if '"SparkListenerTaskEnd"' not in line:
                continue
            event = json.loads(line)
            at = event["Task Info"]["Launch Time"] / 1000
            written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            for name, (begin, end) in spans.items():
                if begin <= at <= end:
                    total[name] += written
    return dict(total)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    log_dir = tempfile.mkdtemp(prefix="larder-bench-events-")
    # Layer tables go under the session's spark.checkpoint.dir (set by the
    # platform); scratch_dir makes a local one only if it is unset.
    spark = local_session(cpus, app="larder-bench", **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    # JVM warm-up (class loading, codegen caches) so the first step is not
    # charged for session start-up.
    spark.range(100_000).selectExpr("sum(id)").collect()
    results = [one_run(spark, sf_dir) for _ in range(runs)]
    spark.stop()  # the log is whole
    names = list(results[0][0])
    times = {n: round(median(r[0][n] for r in results), 3) for n in names}
    moved = shuffled(log_dir, results[-1][1])
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_and_dashboards_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": results[-1][2],
        "shuffle_bytes": {n: moved.get(n, 0) for n in names},
        "runs": runs,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
