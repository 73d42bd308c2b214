"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm caches and the JIT, then is timed ``$BENCH_REPS``
times (default 5); the median warm time is reported.  Execution goes through
the ``noop`` sink, so every row is computed but nothing is collected to the
driver.  Prints ONE JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loomstar.plans.queries import QUERIES  # noqa: E402
from loomstar.session import get_session, scratch_scope  # noqa: E402

HEADLINE = [
    # the nine analytic questions, the global total and the telescoped gap
    "stores_per_country", "stores_per_locality_top7", "sales_by_month_top6", "online_vs_offline",
    "sales_share_by_type", "sales_by_year_month_top10", "staff_by_country",
    "sales_by_type_one_country", "avg_gap_by_year_top5", "avg_gap_telescoped", "sales_total",
    # row-level window, cleaning pipelines, conformance and key checks
    "next_event_gap", "clean_users", "clean_cards", "clean_stores", "clean_products",
    "build_datetime", "conform_products", "conform_violations", "pk_violations", "fk_violations",
    "dedupe_exact",
]

# Reported separately: the whole ETL (six cleaned, conformed table writes and the
# key checks over them), so the headline sum stays comparable across rounds.
ETL = "etl_key_report"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, read from Spark's event log."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if not group:
                        continue
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten":
                            written[group] = written.get(group, 0) + int(acc.get("Value", 0))
    return written


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="loomstar-eventlog-")
    spark = get_session(f"local[{cpus}]", app="loomstar-bench", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                               "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    errors = {}

    def measure(name: str) -> tuple[float, float]:
        t0 = time.perf_counter()
        with scratch_scope(spark):
            run(QUERIES[name](spark, sf_dir))
        first = time.perf_counter() - t0
        times = []
        for rep in range(reps):
            # the last warm run is tagged so its shuffle volume can be read back
            spark.sparkContext.setJobGroup(name if rep == reps - 1 else f"_{name}", name)
            t0 = time.perf_counter()
            with scratch_scope(spark):
                run(QUERIES[name](spark, sf_dir))
                times.append(time.perf_counter() - t0)
        spark.sparkContext.setJobGroup("_idle", "idle")
        return round(first, 3), round(statistics.median(times), 3)

    for name in names:
        try:
            cold[name], warm[name] = measure(name)
        except Exception as err:  # noqa: BLE001 - one failure must not lose the others
            errors[name] = f"{type(err).__name__}: {str(err)[:200]}"
    etl = {}
    if not os.environ.get("BENCH_QUERIES"):
        try:
            etl["cold"], etl["warm"] = measure(ETL)
        except Exception as err:  # noqa: BLE001
            errors[ETL] = f"{type(err).__name__}: {str(err)[:200]}"
    sf = os.path.basename(sf_dir).removeprefix("sf")
    version = spark.version
    spark.stop()  # flushes the event log
    shuffled = shuffle_bytes_by_group(log_dir)
    print(json.dumps({
        "metric": "sum_of_median_warm_query_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "spark": version,
        "master": f"local[{cpus}]",
        "reps": reps,
        "shuffle_bytes": {n: shuffled.get(n, 0) for n in names},
        "etl": {**etl, "shuffle_bytes": shuffled.get(ETL, 0)} if etl else {},
        "errors": errors,
    }))


if __name__ == "__main__":
    main()
