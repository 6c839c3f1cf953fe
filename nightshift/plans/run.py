"""``run_batch``: one nightly batch end to end, in dependency order.

start log -> extract + land (8 tables) -> stage -> type-1 upserts (offices,
employees, customers, productlines, products, orders, orderdetails,
payments) -> type-2 histories and first payments -> daily summaries ->
monthly summaries -> end log.  Each program reads and replaces the partitions
that the batch touches and publishes them when it is done, as the reference
commits per table.  Any exception marks the log row 'F' and is raised (the
reference prints child failures and carries on).

A batch that failed must be run again before the next one starts, and every
program then gives the same table as one undisturbed run: merges meet the
rows that they inserted, histories are compared as a whole, daily facts
replace their own folder, and months that an earlier attempt has rolled
forward (its time stands in their rows) are left out.

``mode="replace"`` (default "append", as the reference) drops the daily rows of
earlier batches that are dated on or after the batch date before the batch's
own are published, and recomputes the months from that date on: batches whose
dates overlap then count every day once.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.operators.rollforward import MONTH, recomputed_months
from nightshift.operators.scd1 import OP, in_parts
from nightshift.operators.scd2 import change_set, history_touched
from nightshift.plans import daily, programs
from nightshift.plans.store import Store
from nightshift.plans.tables import FIRST_PAYMENTS, PAYMENT_MONTH
from nightshift.schemas import LOG_FAILED, LOG_SUCCEEDED, SCD1_SPECS, SCD2_SPECS, SOURCE_TABLES
from nightshift.session import materialize
from nightshift.sources import control, extract

logger = logging.getLogger("nightshift")

# Tables whose programs may run at the same time: each level only reads
# tables written by earlier levels (lookup parents, merged dimensions).
UPSERT_LEVELS = (
    ("offices", "customers", "productlines"),
    ("employees", "products", "orders", "payments"),
    ("orderdetails",),
)


def _together(tasks: dict[str, Callable[[], object]], timings: dict[str, float] | None,
              prefix: str = "") -> dict:
    """Run independent table programs as concurrent Spark jobs.

    The reference starts one process per table; here one driver thread per
    table submits its jobs, so the jobs share the executors.
    """
    import time
    from concurrent.futures import ThreadPoolExecutor

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        took = round(time.perf_counter() - t0, 3)
        logger.info("%s%s done in %.1f s", prefix, name, took)
        if timings is not None:
            timings[prefix + name] = took
        return out

    if len(tasks) == 1:
        (name, fn), = tasks.items()
        return {name: timed(name, fn)}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(timed, name, fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


class _Run:
    """The steps of one batch on a store."""

    def __init__(self, store: Store, batch: Batch, staged: dict[str, DataFrame], attempts: list, mode: str, resolve: bool,
                 counts: dict[str, dict[str, int]] | None):
        self.store, self.batch, self.staged = store, batch, staged
        #: Start times of earlier runs of this batch that did not end well.
        self.attempts = attempts
        self.mode, self.resolve, self.counts = mode, resolve, counts
        self.changes: dict[str, DataFrame] = {}
        self.touched: dict[str, list] = {}

    def upsert(self, t: str) -> None:
        store, batch = self.store, self.batch
        inputs = {n: store.read(n) for n in (t, *[lk.parent for lk in SCD1_SPECS[t].lookups])}
        done = programs.upsert_touched(t, inputs, self.staged[t], batch, store.id_width, self.resolve)
        if done.changes is not None:
            # Read before the table is replaced.
            self.changes[t] = materialize(done.changes)
        self.touched[t] = done.parts
        # I15's row counts, from what the merge did with each row, gathered while the table is written.
        obs = Observation(f"merge_{t}")
        seen = done.marked.observe(obs, *[F.count_if(F.col(OP) == op).alias(n) for op, n in (("u", "updated"), ("i", "inserted"))])
        store.replace_parts(t, seen)
        rows = dict(obs.get)
        logger.info("[%s] updated=%s inserted=%s", t.upper(), rows["updated"], rows["inserted"])
        if self.counts is not None:
            self.counts[t] = rows

    def history(self, name: str) -> None:
        store, spec = self.store, SCD2_SPECS[name]
        active = store.read(name).where(F.col("dw_active_record_ind") == 1)
        if self.attempts:
            # What an earlier run of this batch merged is not among the changes of this one.
            feed = change_set(active, store.read(spec.dim), spec).select(spec.id_col, spec.tracked)
        else:
            feed = self.changes[spec.dim].select(spec.id_col, F.col("new").alias(spec.tracked))
        id_range = F.floor(F.col(spec.id_col) / F.lit(store.id_width)).cast("bigint")
        ranges = [r[0] for r in feed.select(id_range.alias("r")).distinct().collect()]
        if ranges:
            held = active.where(F.col("part").isin(ranges))
            store.replace_parts(name, history_touched(held, feed, spec, self.batch, store.id_width))

    def first_payments(self) -> None:
        store = self.store
        payments = store.read("payments")
        merged = payments.where(in_parts(PAYMENT_MONTH, self.touched["payments"]) & (F.col("etl_batch_no") == self.batch.no))
        changes = self.changes["payments"]
        if self.attempts:
            # Days that an earlier run moved are not told here: every customer of the batch is looked up again.
            changes = merged.select("dw_customer_id", F.col("paymentdate").alias("old"), F.lit(None).cast("date").alias("new"))
        known = store.read(FIRST_PAYMENTS)
        rows, ranges = daily.first_payments_touched(known, payments, merged, changes, store.id_width)
        if ranges:
            rows = materialize(rows)
            left = {r[0] for r in rows.select("id_range").distinct().collect()}
            for r in set(ranges) - left:
                store.clear(FIRST_PAYMENTS, id_range=r)
        store.replace_parts(FIRST_PAYMENTS, rows)

    def daily(self, name: str, fn: Callable, key: str) -> None:
        store, batch = self.store, self.batch
        wh = {t: store.read(t) for t in ("customers", "orders", "orderdetails", "products", "payments", FIRST_PAYMENTS)}
        if self.mode == "replace":
            self.drop_days(name)
        store.write_facts(name, fn(wh, batch), batch.no, ["summary_date", key])

    def drop_days(self, name: str) -> None:
        """Take the rows dated on or after the batch date out of the facts of earlier batches."""
        store, batch = self.store, self.batch
        own = ["etl_batch_no", "summary_month"]
        facts = store.read(name).where((F.col("etl_batch_no") != batch.no) & (F.col("summary_month") >= F.trunc(batch.date_col, "month")))
        # Bounded by the number of partitions of these months.
        met = {tuple(r) for r in facts.where(F.col("summary_date") >= batch.date_col).select(*own).distinct().collect()}
        if not met:
            return
        meant = reduce(lambda a, b: a | b, [(F.col(own[0]) == n) & (F.col(own[1]) == F.lit(m)) for n, m in sorted(met)])
        rest = materialize(facts.where(meant & (F.col("summary_date") < batch.date_col)))
        store.replace_parts(name, rest)
        for n, m in met - {tuple(r) for r in rest.select(*own).distinct().collect()}:
            store.clear(name, etl_batch_no=n, summary_month=m)

    def monthly(self, name: str) -> None:
        """The daily rows dated on or after the batch date, into the months that they lie in."""
        store, batch = self.store, self.batch
        src, key, measures = programs.MONTHLY[name]
        first = F.trunc(batch.date_col, "month")
        facts = store.read(src).where(F.col("summary_month") >= first)
        days = facts if self.mode == "replace" else facts.where(F.col("summary_date") >= batch.date_col)
        months = [r[0] for r in days.select("summary_month").distinct().collect()]
        known = store.read(name)
        if self.mode == "replace":
            gone = {r[0] for r in known.where(F.col(MONTH) >= first).select(MONTH).distinct().collect()} - set(months)
            rows = recomputed_months(facts.drop("summary_month"), known.where(F.col(MONTH).isin(months)), key, measures, batch)
            store.replace_parts(name, rows)
            for m in gone:
                store.clear(name, **{MONTH: m})
            return
        if self.attempts and months:
            ended = known.where(F.col(MONTH).isin(months) & F.col("dw_update_timestamp").isin(self.attempts))
            done = {r[0] for r in ended.select(MONTH).distinct().collect()}
            months = [m for m in months if m not in done]
        if months:
            held = days.where(F.col("summary_month").isin(months)).drop("summary_month")
            store.replace_parts(name, programs.monthly(name, {name: known.where(F.col(MONTH).isin(months)), src: held}, batch))


def run_batch(
    spark: SparkSession,
    store: Store,
    sources: Callable[[str], DataFrame],
    control_table: DataFrame,
    run_ts: dt.datetime,
    landing_root: str,
    end_ts: dt.datetime | None = None,
    landing_format: str = "parquet",
    timings: dict[str, float] | None = None,
    counts: dict[str, dict[str, int]] | None = None,
    resolve_within_batch: bool = False,
    mode: str = "append",
) -> Batch:
    """Run the batch named by ``control_table`` (highest number) into ``store``.

    ``timings``, when given, receives the wall time of every table step;
    ``counts`` the rows updated and inserted per type-1 table (I15).
    ``resolve_within_batch`` lets a new employee find a manager inserted by
    the same batch (off by default, as in the reference).
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode {mode!r} is neither append nor replace")
    cur = control.current_batch(control_table)
    row = cur.first()
    batch = Batch(no=int(row["etl_batch_no"]), date=row["etl_batch_date"], run_ts=run_ts)
    done_before = store.complete_batch()
    if done_before is not None and batch.no <= done_before:
        # A complete batch is final (the reference would append its facts twice).
        raise ValueError(f"batch {batch.no} is not after the complete batch {done_before}")
    begun = store.unfinished(batch.no)
    if [b for b in begun if b != batch.no]:
        raise ValueError(f"batch {begun[0]} was begun and is not complete: run it again before batch {batch.no}")
    runs = store.read_log().where(F.col("etl_batch_no") == batch.no)
    attempts = [r[0] for r in runs.select("etl_batch_start_time").collect()]

    if done_before is None and not attempts:
        store.create()
    # The 'R' row is visible at once; the final status is added at the end.
    started = control.log_start(spark.createDataFrame([], control.LOG_SCHEMA), cur, run_ts)
    store.write_log(started)
    try:
        # Extract -> landing -> stage, all tables at once.
        def land(t):
            path = extract.landing_path(spark, t, batch.date, root=landing_root)
            extract.land(extract.extract_incremental(sources(t), t, batch.date), path, landing_format)
            return extract.stage_load(spark, t, path, landing_format)

        staged = _together({t: partial(land, t) for t in SOURCE_TABLES}, timings, prefix="land_")
        run = _Run(store, batch, staged, attempts, mode, resolve_within_batch, counts)
        # Type-1 upserts level by level; each reads its parents as just published.
        for level in UPSERT_LEVELS:
            tasks = {t: partial(run.upsert, t) for t in level}
            if level == UPSERT_LEVELS[-1]:
                # Histories and first payments need only tables of the levels before.
                tasks |= {name: partial(run.history, name) for name in SCD2_SPECS}
                tasks[FIRST_PAYMENTS] = run.first_payments
            _together(tasks, timings)
        _together({
            "daily_customer_summary": partial(run.daily, "daily_customer_summary", programs.daily_customer, "dw_customer_id"),
            "daily_product_summary": partial(run.daily, "daily_product_summary", programs.daily_product, "dw_product_id"),
        }, timings)
        _together({name: partial(run.monthly, name) for name in programs.MONTHLY}, timings)
    except Exception:
        store.write_log(control.log_end(started, cur, end_ts or run_ts, LOG_FAILED))
        logger.exception("batch %s (%s) failed; run it again", batch.no, batch.date)
        raise
    store.write_log(control.log_end(started, cur, end_ts or run_ts, LOG_SUCCEEDED))
    logger.info("batch %s (%s) complete", batch.no, batch.date)
    return batch
