"""Print the physical plan of every warehouse program on stored tables.

Usage: python tools/show_plans.py [sf_dir] > docs/PLANS.md
Builds a store (first load + the scenario batch) in a fresh scratch folder,
then prints, per program, the operator tree of ``explain("formatted")`` and
the scan lines (pushed filters, read schema).
"""

from __future__ import annotations

import datetime as dt
import io
import os
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compact(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, scans = [], []
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if line.startswith("(") and "Scan" in line:
            block = [line]
            for nxt in lines[i + 1:i + 8]:
                if nxt.startswith(("PushedFilters", "ReadSchema", "PartitionFilters")):
                    block.append("    " + nxt)
            scans.append("\n".join(block))
        elif line.strip() and not line.startswith("(") and not line.startswith(("Output", "Input", "Arguments", "Join", "Keys", "Functions", "Aggregate", "Results", "Condition", "Location", "Batched", "ReadSchema", "PushedFilters", "PartitionFilters", "Left keys", "Right keys", "Join type", "Join condition", "Build", "Generator", "Order", "Partition", "Sort")) and "===" not in line:
            tree.append(line)
    return "\n".join(tree) + "\n\n" + "\n".join(scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from nightshift.plans import daily, programs
    from nightshift.plans.run import run_batch
    from nightshift.plans.store import Store
    from nightshift.session import local_session, materialize
    from nightshift.sources import adapters as A
    from nightshift.sources import extract

    spark = local_session()
    root = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    store = Store(spark, f"{root}/wh")
    ctl = A.batch_control(spark, sf)
    first = ctl.agg(F.min("etl_batch_date")).first()[0]
    before = {}
    for upto, ts, source in ((first, dt.datetime(1995, 1, 2, 1), A.source_before), (A.BATCH.date, A.BATCH.run_ts, A.source)):
        before = {t: materialize(store.read(t)) for t in ("customers", "orderdetails", "customer_history", "monthly_customer_summary")}
        batch = run_batch(spark, store, lambda t, f=source: f(spark, sf, t),
                          ctl.where(F.col("etl_batch_date") <= F.lit(upto)), ts, f"{root}/landing")
    wh = {t: store.read(t) for t in store.tables()}
    stage = {t: extract.stage_load(spark, t, extract.landing_path(spark, t, batch.date, root=f"{root}/landing"))
             for t in ("customers", "orderdetails")}

    def old(table):
        """The warehouse with ``table`` as it was before the batch."""
        return {**wh, table: before[table]}

    progs = {
        "daily_customer_summary (nightly cutoff)": lambda: daily.daily_customer_summary(wh, batch),
        "daily_product_summary (nightly cutoff)": lambda: daily.daily_product_summary(wh, batch),
        "upsert_customers (surrogate ids, no lookups)": lambda: programs.upsert("customers", old("customers"), stage["customers"], batch),
        "upsert_orderdetails (two required lookups)": lambda: programs.upsert("orderdetails", old("orderdetails"), stage["orderdetails"], batch),
        "scd2_customer_history": lambda: programs.history("customer_history", old("customer_history"), batch),
        "monthly_customer_summary": lambda: programs.monthly("monthly_customer_summary", old("monthly_customer_summary"), batch),
    }
    print(f"# Physical plans of the programs\n\nGenerated by `tools/show_plans.py` on {sf} "
          f"(stored warehouse tables before and after the {batch.date} batch, local[*]).\n"
          "AQE may still re-plan shuffles at run time; broadcasts shown here were chosen "
          "behind the measured size of `operators/joins.fits`.\n")
    for name, fn in progs.items():
        print(f"## {name}\n\n```\n{compact(fn())}\n```\n")


if __name__ == "__main__":
    main()
