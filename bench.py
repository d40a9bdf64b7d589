"""Benchmark: runs the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.

Each query is fully executed into the ``noop`` sink (no collect to the driver).
The time includes building the query, i.e. writing its own input files where the
query is a load. Every key runs ``$BENCH_REPEAT`` times (default 2) and the best time
is reported."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parallel_read_files_all",
    "copy_incrementally_delta",
    "system_stats_interval_join",
    "node_durations_root",
    "run_time_chart",
    "upstream_closure",
    "node_cost",
    "redundant_edges",
    "stream_upsert",
    "failure_digest",
]
EXTRA = [
    "sql_join_revenue",
    "timeline_lanes",
    "read_file_make_unique",
    "upsert_on_conflict",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from spark_elt.plans.registry import QUERIES, load_all
    from spark_elt.session import build_session

    load_all()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="spark_elt_bench")
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-elt-bench-"))
    keys = HEADLINE + EXTRA
    if os.environ.get("BENCH_KEYS"):
        keys = os.environ["BENCH_KEYS"].split(",")
    # warm-up: JVM, code shipping, Python workers, parquet footers (not timed)
    QUERIES["node_durations_root"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, 64, 1, cpus).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    for k in keys:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001 - report and go on with the other keys
                errors[k] = f"{type(e).__name__}: {str(e)[:200]}"
                break
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        if best is not None:
            times[k] = round(best, 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times[k] for k in HEADLINE if k in times), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
