"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "valid_positions",
    "night_points",
    "pivot_top3",
    "charging_sessions",
    "charging_places",
    "loan_profile",
    "address_master_merge",
    "vehicle_report",
    "report_delta",
]


def bench_daily_job(spark, sf_dir: str) -> dict[str, float]:
    """The whole daily job on the vendor-table layout: a first run (61 days
    of telemetry) and the next day's incremental run (2 days + state).
    Reported beside the query total, not added to it."""
    import datetime as dt
    import tempfile

    from nightjar.plans.daily import JobConfig, run
    from nightjar.sources import io, proxy
    from nightjar.sources.vendors import PROXY_VENDORS
    from nightjar.streaming import incremental

    root = tempfile.mkdtemp(prefix="nightjar-bench-")
    incremental.land_partitioned(proxy.telemetry_proxy(proxy.read_table(spark, sf_dir, "events")), f"{root}/tel")
    io.write_version(proxy.address_master_source(spark, sf_dir), f"{root}/master", dt.date(2024, 1, 1))
    cfg = JobConfig(
        telemetry=lambda s: incremental.read_partitioned(s, f"{root}/tel"), specs=PROXY_VENDORS,
        state_root=f"{root}/state", master_root=f"{root}/master", report_root=f"{root}/report",
        loan_tables=lambda s: proxy.loan_tables(s, sf_dir),
        loan_pairs=lambda s: proxy.loan_vehicle_pairs_source(s, sf_dir),
        geocode_cache=lambda s: proxy.geocode_reference(s, sf_dir))
    out = {}
    for label, day in (("first_run", dt.date(2024, 1, 30)), ("incremental_run", dt.date(2024, 1, 31))):
        t0 = time.time()
        run(spark, day, cfg)
        out[label] = round(time.time() - t0, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from nightjar.plans.catalog import QUERIES
    from nightjar.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="nightjar-bench")
    # JVM warm-up (class loading, JIT, codegen caches) on the smallest scale:
    # other input files, so no result or cached input carries over.
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if warmup_dir and os.path.isdir(warmup_dir) and os.path.abspath(warmup_dir) != os.path.abspath(sf_dir):
        for name in only or HEADLINE:
            QUERIES[name](spark, warmup_dir).write.format("noop").mode("overwrite").save()
    else:
        warmup_dir = None
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    daily: dict = {}
    if not only:
        try:
            daily = bench_daily_job(spark, sf_dir)
        except Exception as exc:  # noqa: BLE001  the query timings above still stand
            daily = {"error": repr(exc)[:200]}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "master": f"local[{cpus}]",
        "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory", "default"),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "session": "one session, queries in order, each fully computed",
        "warmup": f"one pass of the same queries over {warmup_dir}" if warmup_dir else None,
        "daily_job": daily,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
