"""Command line: run one batch (the reference's nightly master chain).

    python -m nightshift run-batch --sources DIR --control PATH --warehouse DIR
        [--landing DIR] [--landing-format parquet|csv] [--run-ts ISO]

``--sources`` holds one Parquet dataset per source table (offices employees
customers productlines products orders orderdetails payments) with the
columns of ``schemas.SOURCE_SCHEMAS``; ``--control`` is the batch_control
table (etl_batch_no, etl_batch_date).  The batch with the highest number is
run into the snapshot store at ``--warehouse`` and the step timings are
printed as JSON.  Paths should be on shared storage when on a cluster; the
session's ``spark.checkpoint.dir`` must be set there too.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="nightshift")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run-batch", help="extract, stage and merge one batch")
    r.add_argument("--sources", required=True)
    r.add_argument("--control", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--landing", default=None)
    r.add_argument("--landing-format", default="parquet", choices=("parquet", "csv"))
    r.add_argument("--run-ts", default=None, help="run timestamp (default: now, UTC)")
    r.add_argument("--mode", default="append", choices=("append", "replace"), help="replace: days that earlier batches have are counted anew")
    r.add_argument("--batch-no", type=int, default=None, help="run this batch (a failed one, say) instead of the newest")
    args = p.parse_args(argv)
    import logging

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")

    from nightshift.plans.run import run_batch
    from nightshift.plans.store import Store
    from nightshift.schemas import SOURCE_SCHEMAS
    from nightshift.session import ensure_checkpoint_dir

    spark = SparkSession.builder.appName("nightshift").getOrCreate()
    ensure_checkpoint_dir(spark)
    sources = args.sources.rstrip("/")
    run_ts = (dt.datetime.fromisoformat(args.run_ts) if args.run_ts
              else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0))
    timings: dict[str, float] = {}
    counts: dict[str, dict[str, int]] = {}
    batch = run_batch(
        spark,
        Store(spark, args.warehouse),
        lambda t: spark.read.schema(SOURCE_SCHEMAS[t]).parquet(f"{sources}/{t}"),
        spark.read.parquet(args.control).where(F.lit(True) if args.batch_no is None else F.col("etl_batch_no") <= args.batch_no),
        run_ts,
        args.landing or f"{args.warehouse.rstrip('/')}/_landing",
        landing_format=args.landing_format,
        timings=timings,
        counts=counts,
        mode=args.mode,
    )
    print(json.dumps({"batch_no": batch.no, "batch_date": batch.date.isoformat(),
                      "rows": counts, "steps": timings}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
