"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query once to warm up the JVM (and to store the derived inputs once),
then twice timed; reports the faster run.  A query's time covers building its
plan (including the small planning actions: dimension size check, split-point
sample) and executing it completely into Spark's ``noop`` sink.  Prints one JSON
line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from revaudit.plans.catalog import QUERIES  # noqa: E402
from revaudit.plans.refresh import refresh  # noqa: E402
from revaudit.session import build_session, work_path  # noqa: E402
from revaudit.sources import testdata  # noqa: E402

HEADLINE = ("source_fingerprint", "invoice_match", "billing_events", "nearest_billing",
            "nearest_billing_window", "enriched_movements", "numbered_movements")


def _run_query(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()


def _run_refresh(spark, sf_dir, run_no):
    import uuid
    root = work_path(spark, "bench", uuid.uuid4().hex[:12])
    result = refresh(spark, testdata.load(spark, sf_dir), root, force=True)
    assert result.refreshed, result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="revaudit-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    jobs = {name: (lambda n=name: _run_query(spark, n, sf_dir)) for name in HEADLINE}
    jobs["refresh_job"] = lambda: _run_refresh(spark, sf_dir, 0)
    for job in jobs.values():  # warm-up (also stores the derived inputs once)
        job()
    times = {}
    for name, job in jobs.items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            job()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
