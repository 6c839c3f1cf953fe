"""Multi-batch end to end: first load, then the scenario batch."""

import datetime as dt
import io
import pathlib
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.plans import daily
from nightshift.plans.run import run_batch
from nightshift.plans.store import Store
from nightshift.sources import adapters as A
from nightshift.sources import control


def _control(spark, sf, upto):
    return A.batch_control(spark, sf, upto)


def test_two_batches(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    first_day = A.batch_control(spark, sf).agg(F.min("etl_batch_date")).first()[0]
    b1 = run_batch(spark, store, src, _control(spark, sf, first_day),
                   dt.datetime(1995, 1, 2, 1, 0), f"{scratch}/landing")
    assert store.complete_batch() == b1.no
    n_cust = store.read("customers").count()
    # First load takes every customer whose update day >= the first batch day.
    expect = src("customers").where(F.to_date("update_timestamp") >= F.lit(first_day)).count()
    assert n_cust == expect
    # One row per natural key, ids dense from 1.
    ids = store.read("customers").agg(F.min("dw_customer_id"), F.max("dw_customer_id"),
                                      F.countDistinct("src_customernumber")).first()
    assert (ids[0], ids[1], ids[2]) == (1, n_cust, n_cust)
    # History: one active row per customer after the first load.
    h = store.read("customer_history")
    assert h.where("dw_active_record_ind = 1").count() == n_cust

    counts = {}
    b2 = run_batch(spark, store, src, _control(spark, sf, A.BATCH.date),
                   dt.datetime(2001, 6, 16, 2, 0), f"{scratch}/landing", counts=counts)
    staged_customers = src("customers").where(F.to_date("update_timestamp") >= F.lit(b2.date)).count()
    assert counts["customers"]["updated"] + counts["customers"]["inserted"] == staged_customers
    assert b2.date <= A.BATCH.date and b2.no > b1.no
    cust = store.read("customers")
    assert cust.count() == cust.select("src_customernumber").distinct().count()
    # At most one active history row per id.
    h2 = store.read("customer_history")
    assert h2.where("dw_active_record_ind = 1").groupBy("dw_customer_id").count() \
        .where("count > 1").count() == 0
    log = store.read("batch_control_log").orderBy("etl_batch_no").collect()
    assert [r["etl_batch_status"] for r in log] == ["S", "S"]
    # Daily rows of both batches are readable; monthly sums equal daily sums
    # (first load + second batch, customers' order counts).
    daily = store.read("daily_customer_summary")
    assert daily.select("etl_batch_no").distinct().count() == 2
    monthly = store.read("monthly_customer_summary")
    assert monthly.count() > 0

    # A third consecutive batch carries the state forward again.
    b3 = run_batch(spark, store, src, _control(spark, sf, dt.date(2001, 7, 15)),
                   dt.datetime(2001, 7, 16, 2, 0), f"{scratch}/landing")
    assert b3.no > b2.no
    cust3 = store.read("customers")
    assert cust3.count() == cust3.select("src_customernumber").distinct().count()
    h3 = store.read("customer_history")
    assert h3.where("dw_active_record_ind = 1").groupBy("dw_customer_id").count() \
        .where("count > 1").count() == 0
    # Every dimension row has exactly one active version.
    assert h3.where("dw_active_record_ind = 1").count() == cust3.count()
    # Closed versions lie in the partition of the batch that closed them.
    assert h3.where("dw_active_record_ind = 0 AND part <> update_etl_batch_no").count() == 0
    log3 = store.read("batch_control_log").orderBy("etl_batch_no").collect()
    assert [r["etl_batch_no"] for r in log3] == [b1.no, b2.no, b3.no]
    assert store.read("daily_customer_summary").select("etl_batch_no").distinct().count() == 3
    # Monthly: one row for each month and customer.
    mon = store.read("monthly_customer_summary")
    assert mon.count() == mon.select("start_of_the_month_date", "dw_customer_id").distinct().count()
    # First payments are kept equal to what all payments say.
    firsts = store.read("payments").groupBy("dw_customer_id").agg(F.min("paymentdate").alias("d"))
    assert rows_of(store.read("first_payments").select("dw_customer_id", "first_payment_date")) == rows_of(firsts)
    # A line is stored in the month of its order.
    lines = store.read("orderdetails").join(store.read("orders").select("dw_order_id", F.col("order_month").alias("m")), "dw_order_id")
    assert lines.count() == store.read("orderdetails").count() and lines.where("order_month <> m").count() == 0


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_failed_batch_publishes_nothing(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    first_day = A.batch_control(spark, sf).agg(F.min("etl_batch_date")).first()[0]
    run_batch(spark, store, src, _control(spark, sf, first_day),
              dt.datetime(1995, 1, 2, 1, 0), f"{scratch}/landing")
    before = {t: rows_of(store.read(t)) for t in store.tables()}

    def broken(t):
        if t == "orders":
            raise RuntimeError("source down")
        return src(t)

    try:
        run_batch(spark, store, broken, _control(spark, sf, A.BATCH.date),
                  dt.datetime(2001, 6, 16, 2, 0), f"{scratch}/landing")
        raise AssertionError("expected failure")
    except RuntimeError:
        pass
    assert {t: rows_of(store.read(t)) for t in store.tables()} == before
    assert [r["etl_batch_status"] for r in store.read("batch_control_log").orderBy("etl_batch_no").collect()] == ["S", "F"]


def test_committed_batch_is_not_rerun(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    first_day = A.batch_control(spark, sf).agg(F.min("etl_batch_date")).first()[0]
    ctl = _control(spark, sf, first_day)
    run_batch(spark, store, src, ctl, dt.datetime(1995, 1, 2, 1, 0), f"{scratch}/landing")
    try:
        run_batch(spark, store, src, ctl, dt.datetime(1995, 1, 2, 5, 0), f"{scratch}/landing")
        raise AssertionError("expected refusal")
    except ValueError:
        pass


def test_cli_runs_a_batch(spark, sf, scratch):
    from nightshift.__main__ import main
    from nightshift.schemas import SOURCE_TABLES

    for t in SOURCE_TABLES:
        A.source(spark, sf, t).write.parquet(f"{scratch}/src/{t}")
    first_day = A.batch_control(spark, sf).agg(F.min("etl_batch_date")).first()[0]
    _control(spark, sf, first_day).write.parquet(f"{scratch}/control")
    assert main(["run-batch", "--sources", f"{scratch}/src", "--control", f"{scratch}/control",
                 "--warehouse", f"{scratch}/wh", "--landing-format", "csv",
                 "--run-ts", "1995-01-02T01:00:00"]) == 0
    store = Store(spark, f"{scratch}/wh")
    assert store.read("customers").count() == A.source(spark, sf, "customers").count()


def _facts(spark, store, rows):
    """Daily product rows ``(day, id, cost, batch)`` in the stored shape."""
    schema = store.read("daily_product_summary").drop("summary_month").schema
    made = spark.createDataFrame(rows, "summary_date date, dw_product_id bigint, product_cost_amount int, etl_batch_no int")
    return made.select(*[(F.col(f.name) if f.name in made.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def test_append_rerun_leaves_no_stale_month(spark, scratch):
    store, name = Store(spark, f"{scratch}/wh"), "daily_product_summary"
    store.write_facts(name, _facts(spark, store, [(dt.date(2001, 6, 20), 1, 1, 5), (dt.date(2001, 7, 2), 1, 1, 5)]), 5)
    store.write_facts(name, _facts(spark, store, [(dt.date(2001, 6, 21), 2, 3, 5)]), 5)
    rows = store.read(name).collect()
    assert [(r["summary_date"], r["product_cost_amount"], r["etl_batch_no"]) for r in rows] == [(dt.date(2001, 6, 21), 3, 5)]


def test_history_closes_are_sealed(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    first_day = A.batch_control(spark, sf).agg(F.min("etl_batch_date")).first()[0]
    run_batch(spark, store, src, _control(spark, sf, first_day),
              dt.datetime(1995, 1, 2, 1, 0), f"{scratch}/landing")

    def changed(t):
        df = src(t)
        if t == "customers":
            bump = F.to_date("update_timestamp") >= F.lit(A.BATCH.date)
            df = df.withColumn("creditlimit", F.when(bump, F.coalesce("creditlimit", F.lit(0)) + 1)
                               .otherwise(F.col("creditlimit")).cast("decimal(12,2)"))
        return df

    b2 = run_batch(spark, store, changed, _control(spark, sf, A.BATCH.date),
                   dt.datetime(2001, 6, 16, 2, 0), f"{scratch}/landing")
    bumped = src("customers").where(F.to_date("update_timestamp") >= F.lit(b2.date)).count()
    hist = store.read("customer_history")
    closed = hist.where("dw_active_record_ind = 0")
    assert closed.count() == bumped > 0
    assert closed.where(F.col("effective_to_date") == F.date_sub(F.lit(b2.date), 1)).count() == bumped
    assert closed.where(F.col("part") == b2.no).count() == bumped
    assert hist.where("dw_active_record_ind = 1").count() == store.read("customers").count()


def _batch(spark, no, day):
    return spark.createDataFrame([(no, day)], "etl_batch_no int, etl_batch_date date")


def test_failed_batch_run_again_equals_an_undisturbed_one(spark, sf, scratch, monkeypatch):
    """A batch that fails late, when most tables and one monthly table are published."""
    from nightshift.plans import programs

    src = lambda t: A.source(spark, sf, t)
    stores = {}
    for name in ("clean", "failed"):
        store = stores[name] = Store(spark, f"{scratch}/{name}", id_width=40)
        run_batch(spark, store, lambda t: A.source_before(spark, sf, t), _batch(spark, 1, dt.date(2001, 4, 10)), dt.datetime(2001, 5, 11), f"{scratch}/landing")
        seen = []

        def broken(table, *args, whole=programs.monthly, store=store):
            if "product" in table:
                # The log shows the running batch while it runs.
                seen.append([r["etl_batch_status"] for r in store.read("batch_control_log").orderBy("etl_batch_no").collect()])
                raise RuntimeError("no months today")
            return whole(table, *args)

        if name == "failed":
            with monkeypatch.context() as m, pytest.raises(RuntimeError, match="no months"):
                m.setattr(programs, "monthly", broken)
                run_batch(spark, store, src, _batch(spark, 2, dt.date(2001, 6, 10)), dt.datetime(2001, 6, 11), f"{scratch}/landing")
            assert seen[0] == ["S", "R"]
            with pytest.raises(ValueError, match="run it again"):
                run_batch(spark, store, src, _batch(spark, 3, dt.date(2001, 6, 20)), dt.datetime(2001, 6, 21), f"{scratch}/landing")
        run_batch(spark, store, src, _batch(spark, 2, dt.date(2001, 6, 10)), dt.datetime(2001, 6, 11), f"{scratch}/landing")
        assert store.complete_batch() == 2 and store.unfinished(2) == []
    for t in stores["clean"].tables():
        assert rows_of(stores["failed"].read(t)) == rows_of(stores["clean"].read(t)), t


def files(store, table):
    """Partition -> names of its files."""
    out = {}
    for p in pathlib.Path(store.path(table)).rglob("part-*.parquet"):
        out.setdefault(str(p.parent.relative_to(store.path(table))), set()).add(p.name)
    return out


def test_small_batch_rewrites_few_partitions(spark, sf, scratch):
    """One order, its lines and one customer change: one month and one id range are written, the rest stays as it is."""
    store = Store(spark, f"{scratch}/wh", id_width=20)
    run_batch(spark, store, lambda t: A.source(spark, sf, t), _batch(spark, 1, dt.date(1990, 1, 1)), dt.datetime(2001, 5, 11), f"{scratch}/landing")
    tables = ("customers", "products", "orders", "orderdetails", "payments", "customer_history", "product_history", "offices")
    before = {t: files(store, t) for t in tables}
    old = store.read("orders").where("order_month = '1996-03-01' AND lower(trim(status)) = 'shipped'").orderBy("src_ordernumber").first()
    today = F.lit(dt.datetime(2001, 6, 10, 5)).cast("timestamp_ntz")

    def source(t):
        df = A.source(spark, sf, t)
        if t in ("orders", "orderdetails"):
            df = df.where(F.col("ordernumber") == old["src_ordernumber"])
            if t == "orders":
                # Shipped late; its date moves to another month as well.
                df = df.withColumn("orderdate", F.lit(dt.date(2001, 6, 9))).withColumn("shippeddate", F.lit(dt.date(2001, 6, 10)))
        elif t == "customers":
            df = df.where(F.col("customernumber") == old["src_customernumber"]).withColumn("creditlimit", F.lit(7).cast("decimal(12,2)"))
        else:
            df = df.where("false")
        return df.withColumn("update_timestamp", today)

    run_batch(spark, store, source, _batch(spark, 2, dt.date(2001, 6, 10)), dt.datetime(2001, 6, 11), f"{scratch}/landing")
    after = {t: files(store, t) for t in tables}
    written = {t: sorted(p for p in after[t] if after[t][p] != before[t].get(p)) for t in tables}
    one = (old["dw_customer_id"]) // 20
    assert written == {
        "customers": [f"id_range={one}"], "orders": ["order_month=1996-03-01"], "orderdetails": ["order_month=1996-03-01"],
        "customer_history": ["dw_active_record_ind=0/part=2", f"dw_active_record_ind=1/part={one}"],
        "products": [], "payments": [], "product_history": [], "offices": [],
    }
    assert all(len(before[t]) > 3 for t in ("customers", "products", "orders", "orderdetails", "payments"))
    # The order moved to another month of its date and kept its place, where its lines are found.
    assert store.read("orders").where(F.col("dw_order_id") == old["dw_order_id"]).first()["orderdate"] == dt.date(2001, 6, 9)
    wh = {t: store.read(t) for t in store.tables()}
    got = daily.daily_customer_summary(wh, Batch(2, dt.date(2001, 6, 10), dt.datetime(2001, 6, 11)))
    late = got.where((F.col("dw_customer_id") == old["dw_customer_id"]) & (F.col("summary_date") == F.lit(dt.date(2001, 6, 10))))
    assert late.first()["shipped_order_count"] >= 1
    # Only the partitions of the batch's orders are read of the lines, and the payments' history not at all.
    plan = explained(got)
    assert "dynamicpruning" in plan and "order_month" in plan
    assert [x for x in plan.splitlines() if "ReadSchema" in x and "paymentdate" in x and "amount" not in x] == []


def explained(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_first_payments_follow_moved_days(spark, sf, scratch):
    """A customer's first payment moves to a later day, another loses its day, a third gets an earlier one."""
    store = Store(spark, f"{scratch}/wh", id_width=20)
    run_batch(spark, store, lambda t: A.source(spark, sf, t), _batch(spark, 1, dt.date(1990, 1, 1)), dt.datetime(2001, 5, 11), f"{scratch}/landing")
    some = [r[0] for r in store.read("payments").groupBy("src_customernumber").count().where("count > 2").orderBy("src_customernumber").limit(3).collect()]
    today = F.lit(dt.datetime(2001, 6, 10, 5)).cast("timestamp_ntz")

    def source(t):
        df = A.source(spark, sf, t)
        if t != "payments":
            return df.where("false")
        day, c = F.col("paymentdate"), F.col("customernumber")
        least = df.groupBy(c.alias("c")).agg(F.min("paymentdate").alias("least"))
        first = df.join(least, (F.col("c") == c) & (F.col("least") == day)).drop("c", "least").where(c.isin(some))
        moved = F.when(c == some[0], F.lit(dt.date(2001, 6, 10))).when(c == some[1], F.lit(None)).otherwise(F.date_sub(day, 400))
        return first.withColumn("paymentdate", moved).withColumn("update_timestamp", today)

    run_batch(spark, store, source, _batch(spark, 2, dt.date(2001, 6, 10)), dt.datetime(2001, 6, 11), f"{scratch}/landing")
    want = store.read("payments").where("paymentdate IS NOT NULL").groupBy("dw_customer_id").agg(F.min("paymentdate"))
    assert rows_of(store.read("first_payments").select("dw_customer_id", "first_payment_date")) == rows_of(want)


def test_replace_counts_overlapping_days_once(spark, sf, scratch):
    """Batch 2 is dated before batch 1's last days: append takes them again, replace does not."""
    src = lambda t: A.source(spark, sf, t)
    got = {}
    for mode in ("append", "replace"):
        store = Store(spark, f"{scratch}/{mode}")
        for no, day in ((1, dt.date(2001, 5, 10)), (2, dt.date(2001, 6, 10))):
            run_batch(spark, store, src, _batch(spark, no, day), dt.datetime(2001, 7, no), f"{scratch}/landing", mode=mode)
        got[mode] = store
    late = F.col("summary_date") >= F.lit(dt.date(2001, 6, 10))
    for name, key in (("daily_customer_summary", "dw_customer_id"), ("daily_product_summary", "dw_product_id")):
        twice = got["append"].read(name).where(late).groupBy("summary_date", key).count().where("count > 1").count()
        once = got["replace"].read(name)
        assert twice > 0 and once.groupBy("summary_date", key).count().where("count > 1").count() == 0
        early = ~late & (F.col("etl_batch_no") == 1)
        assert once.where(late & (F.col("etl_batch_no") == 1)).count() == 0
        assert rows_of(once.where(early).select("summary_date", key)) == rows_of(got["append"].read(name).where(early).select("summary_date", key))
        assert "product" in name or not once.where(early).isEmpty()
    days, months = got["replace"].read("daily_customer_summary"), got["replace"].read("monthly_customer_summary")
    want = days.groupBy(F.trunc("summary_date", "month").alias("m"), "dw_customer_id").agg(F.sum("order_count").alias("n"))
    assert rows_of(months.select("start_of_the_month_date", "dw_customer_id", "order_count")) == rows_of(want)


def test_counts_rest_on_no_clock(spark, sf, scratch):
    """Two batches with one run time: what the second one updates is not taken for inserted."""
    store, ts = Store(spark, f"{scratch}/wh"), dt.datetime(2001, 7, 1)
    for no in (1, 2):
        counts = {}
        run_batch(spark, store, lambda t: A.source(spark, sf, t), _batch(spark, no, dt.date(2001, 6, 10)), ts, f"{scratch}/landing", counts=counts)
        n = A.source(spark, sf, "customers").where(F.to_date("update_timestamp") >= F.lit(dt.date(2001, 6, 10))).count()
        assert counts["customers"] == ({"updated": 0, "inserted": n} if no == 1 else {"updated": n, "inserted": 0}) and n > 0


def test_dates_that_go_back_update_their_months(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    for no, day in ((1, dt.date(2001, 5, 10)), (2, dt.date(2001, 6, 10)), (3, dt.date(2001, 5, 20))):
        run_batch(spark, store, src, _batch(spark, no, day), dt.datetime(2001, 7, no), f"{scratch}/landing{no}")
    for name, key in (("monthly_customer_summary", "dw_customer_id"), ("monthly_product_summary", "dw_product_id")):
        m = store.read(name)
        assert m.count() == m.select("start_of_the_month_date", key).distinct().count() > 0
    # The earlier month took the late rows of batch 3.
    m = store.read("monthly_customer_summary")
    assert m.where("start_of_the_month_date = '2001-05-01' AND etl_batch_no = 3").count() > 0


def test_first_batch_without_events(spark, sf, scratch):
    store = Store(spark, f"{scratch}/wh")
    src = lambda t: A.source(spark, sf, t)
    run_batch(spark, store, src, _batch(spark, 1, dt.date(2030, 1, 1)), dt.datetime(2030, 1, 2), f"{scratch}/landing")
    assert {t: store.read(t).count() for t in store.tables()} == {t: 0 for t in store.tables()}
    run_batch(spark, store, src, _batch(spark, 2, dt.date(2030, 1, 2)), dt.datetime(2030, 1, 3), f"{scratch}/landing")


def test_rows_of_another_batch_are_refused(spark, scratch):
    store = Store(spark, f"{scratch}/wh")
    rows = _facts(spark, store, [(dt.date(2001, 6, 20), 1, 1, 5), (dt.date(2001, 6, 20), 2, 1, 4)])
    with pytest.raises(Exception, match="another batch"):
        store.write_facts("daily_product_summary", rows, 5)


def test_log_of_two_runs_with_one_start_time(spark, scratch):
    store, ts = Store(spark, f"{scratch}/wh"), dt.datetime(2001, 7, 1)
    for status, end in (("R", None), ("F", ts), ("R", None), ("S", ts)):
        row = spark.createDataFrame([(4, dt.date(2001, 6, 30), status, ts, end)], control.LOG_SCHEMA)
        store.write_log(row)
    assert [r["etl_batch_status"] for r in store.read("batch_control_log").collect()] == ["S"]
    assert store.complete_batch() == 4 and store.unfinished(4) == []
