"""Benchmark the warehouse programs; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per program, default 3, after one warm-up).

1. ``run_batch_first_load``: a whole batch (all 8 tables extracted, landed,
   staged and merged, histories, daily and monthly facts) into an empty
   store, from the source as it was before the scenario's batch.
2. ``run_batch_nightly``: the next batch (2001-06-15) from the source of that
   day: new rows, changed attributes, versions to close, a new month.
   ``counts`` has the rows it updated and inserted and the versions closed.
   merges and roll-forwards on the tables as they were before the nightly
   batch, daily programs on the tables after it; executed in full with the
   ``noop`` sink; median of the runs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from pyspark.sql import functions as F

    from nightshift.plans import daily, programs
    from nightshift.plans.run import run_batch
    from nightshift.plans.store import Store
    from nightshift.session import local_session, materialize, scratch_path
    from nightshift.sources import adapters as A
    from nightshift.sources import extract

    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)))
    results: dict[str, float] = {}
    steps: dict[str, dict[str, float]] = {}

    # Warm-up: one small first-load batch (sf0.001 if present) so that JIT
    # compilation and class loading are not charged to the timed batches.
    warm_sf = os.path.join(os.path.dirname(sf), "sf0.001")
    if os.path.isdir(warm_sf):
        warm = scratch_path(spark, "bench-warmup", str(int(time.time() * 1000)))
        wctl = A.batch_control(spark, warm_sf)
        wday = wctl.agg(F.min("etl_batch_date")).first()[0]
        run_batch(spark, Store(spark, f"{warm}/wh"), lambda t: A.source(spark, warm_sf, t),
                  wctl.where(F.col("etl_batch_date") <= F.lit(wday)),
                  dt.datetime(1995, 1, 2, 1, 0), f"{warm}/landing")

    root = scratch_path(spark, "bench", str(int(time.time() * 1000)))
    store = Store(spark, f"{root}/wh")
    landing = f"{root}/landing"
    control = A.batch_control(spark, sf)
    counts: dict[str, dict[str, int]] = {}
    first_day = control.agg(F.min("etl_batch_date")).first()[0]

    before = {}
    for name, upto, ts, source in (
        ("run_batch_first_load", first_day, dt.datetime(1995, 1, 2, 1, 0), A.source_before),
        ("run_batch_nightly", A.BATCH.date, A.BATCH.run_ts, A.source),
    ):
        # Copies of the tables that the timed programs start from: the batch replaces their partitions.
        before = {t: materialize(store.read(t)) for t in ("orderdetails", "customer_history", "monthly_customer_summary")}
        steps[name] = {}
        counts = {}
        t0 = time.perf_counter()
        batch = run_batch(spark, store, lambda t, f=source: f(spark, sf, t),
                          control.where(F.col("etl_batch_date") <= F.lit(upto)), ts, landing,
                          timings=steps[name], counts=counts)
        results[name] = round(time.perf_counter() - t0, 3)
    for h in ("customer_history", "product_history"):
        counts[h] = {"closed": store.read(h).where("dw_active_record_ind = 0").count()}

    wh = {t: store.read(t) for t in store.tables()}
    staged = extract.stage_load(spark, "orderdetails",
                                extract.landing_path(spark, "orderdetails", batch.date, root=landing))
    full = A.FULL_HISTORY

    programs_to_time = {
        "daily_customer_summary": lambda: daily.daily_customer_summary(wh, batch),
        "daily_customer_summary_full": lambda: daily.daily_customer_summary(wh, full),
        "daily_product_summary_full": lambda: daily.daily_product_summary(wh, full),
        "upsert_orderdetails": lambda: programs.upsert(
            "orderdetails", {**wh, "orderdetails": before["orderdetails"]}, staged, batch),
        "scd2_customer_history": lambda: programs.history(
            "customer_history", {**wh, "customer_history": before["customer_history"]}, batch),
        "monthly_customer_summary": lambda: programs.monthly(
            "monthly_customer_summary", {**wh, "monthly_customer_summary": before["monthly_customer_summary"]}, batch),
    }

    def run_once(fn):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name, fn in programs_to_time.items():
        run_once(fn)  # warm-up
        results[name] = round(statistics.median(run_once(fn) for _ in range(runs)), 3)

    sf_name = os.path.basename(sf).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf_name) if sf_name.replace(".", "").isdigit() else sf_name,
        "cpus": int(cpus),
        "runs": runs,
        "counts": counts,
        "batch_steps": steps,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
