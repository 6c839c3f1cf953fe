"""Handmade cases (FIXTURES.md §4): one per trap of SURVEY §2 I-semantics."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.operators.rollforward import rollforward_merge
from nightshift.operators.scd1 import latest_per_key, scd1_merge, scd1_merge_parts
from nightshift.operators.scd2 import scd2_merge
from nightshift.operators.surrogate import assign_surrogate_keys
from nightshift.plans import daily
from nightshift.schemas import (
    DAILY_CUSTOMER_MEASURES, SCD1_SPECS, SCD2_SPECS, SOURCE_SCHEMAS,
)
from nightshift.sources import control, extract

D = dt.date(2001, 6, 15)
B = Batch(no=7, date=D, run_ts=dt.datetime(2001, 6, 16, 2, 0))
TS = dt.datetime(2001, 1, 1, 9, 0)
OLD = dt.date(2001, 1, 1)


def ts(d, h=9):
    return dt.datetime(d.year, d.month, d.day, h)


# --- A: extract / stage ---------------------------------------------------------------

def test_cutoff_inclusive_and_null(spark):
    rows = [("a", "1", ts(D - dt.timedelta(days=1), 23)), ("b", "2", ts(D, 0)), ("c", "3", ts(D, 23)),
            ("d", "4", ts(D + dt.timedelta(days=3))), ("e", "5", None)]
    src = spark.createDataFrame(rows, "productline string, textdescription string, update_timestamp timestamp_ntz") \
        .select(F.col("productline"), "textdescription", F.lit(None).cast("string").alias("htmldescription"),
                F.lit(None).cast("string").alias("image"), F.lit(None).cast("timestamp_ntz").alias("create_timestamp"),
                "update_timestamp")
    got = sorted(r[0] for r in extract.extract_incremental(src, "productlines", D).collect())
    assert got == ["b", "c", "d"]


def test_blanks_as_null(spark):
    df = spark.createDataFrame([("",), ("  ",), (" x ",), (None,)], "s string")
    assert [r[0] for r in extract.blanks_as_null(df).collect()] == [None, None, " x ", None]


def test_csv_landing_keeps_text(spark, scratch):
    schema = SOURCE_SCHEMAS["productlines"]
    odd = 'a, "quoted"\nnext line '
    rows = [("L1", odd, " lead", "", ts(OLD), ts(D)), ("L2", None, "  ", None, ts(OLD), ts(D))]
    df = spark.createDataFrame(rows, schema)
    path = f"{scratch}/landing/productlines"
    extract.land(df, path, fmt="csv")
    back = {r[0]: r for r in extract.stage_load(spark, "productlines", path, fmt="csv").collect()}
    assert back["L1"]["textdescription"] == odd
    assert back["L1"]["htmldescription"] == " lead"
    assert back["L1"]["image"] is None and back["L2"]["htmldescription"] is None


# --- I1-I8: type-1 merges -----------------------------------------------------------------

PL = SCD1_SPECS["productlines"]


def _pl_target(spark, rows):
    return spark.createDataFrame(
        rows, "dw_product_line_id bigint, productline string, textdescription string, "
              "htmldescription string, image string, src_create_timestamp timestamp_ntz, "
              "src_update_timestamp timestamp_ntz, dw_create_timestamp timestamp_ntz, "
              "dw_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date")


def _pl_stage(spark, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS["productlines"])


def test_scd1_restamps_unchanged_rows_and_numbers_new(spark):
    target = _pl_target(spark, [(1, "A", "same", None, None, TS, TS, TS, TS, 6, OLD),
                                (2, "B", "keep", None, None, TS, TS, TS, TS, 6, OLD)])
    stage = _pl_stage(spark, [("A", "same", None, None, TS, ts(D)), ("C", "new", None, None, ts(D), ts(D)),
                              ("0", "first", None, None, ts(D), ts(D))])
    out = {r["productline"]: r for r in scd1_merge(target, stage, PL, B).collect()}
    assert out["A"]["etl_batch_no"] == 7 and out["A"]["src_update_timestamp"] == ts(D)
    assert out["A"]["dw_create_timestamp"] == TS  # never changes
    assert out["B"]["etl_batch_no"] == 6
    # New ids continue after the largest, in natural key order.
    assert (out["0"]["dw_product_line_id"], out["C"]["dw_product_line_id"]) == (3, 4)
    assert out["C"]["dw_create_timestamp"] == B.run_ts


def test_duplicate_stage_key_latest_wins(spark):
    stage = _pl_stage(spark, [("A", "older", None, None, TS, ts(D)), ("A", "newer", None, None, TS, ts(D, 20))])
    got = latest_per_key(stage, ["productline"]).collect()
    assert len(got) == 1 and got[0]["textdescription"] == "newer"


def _orders_target(spark, rows):
    return spark.createDataFrame(
        rows, "dw_order_id bigint, src_ordernumber bigint, orderdate date, requireddate date, "
              "shippeddate date, status string, comments string, src_customernumber bigint, "
              "cancelleddate date, dw_customer_id bigint, src_create_timestamp timestamp_ntz, "
              "src_update_timestamp timestamp_ntz, dw_create_timestamp timestamp_ntz, "
              "dw_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date")


def test_stale_lookup_and_required_orphans(spark):
    spec = SCD1_SPECS["orders"]
    target = _orders_target(spark, [(1, 100, OLD, OLD, None, "In Process", None, 5, None, 50, TS, TS, TS, TS, 6, OLD)])
    customers = spark.createDataFrame([(50, 5), (60, 6)], "dw_customer_id bigint, src_customernumber bigint")
    stage = spark.createDataFrame([
        (100, OLD, OLD, None, "In Process", None, 6, None, TS, ts(D)),  # moves to customer 6
        (101, D, D, None, "In Process", None, 6, None, ts(D), ts(D)),   # new, customer known
        (102, D, D, None, "In Process", None, 9, None, ts(D), ts(D)),   # orphan: dropped
    ], SOURCE_SCHEMAS["orders"])
    out = {r["src_ordernumber"]: r for r in scd1_merge(target, stage, spec, B, {"customers": customers}).collect()}
    assert out[100]["src_customernumber"] == 6 and out[100]["dw_customer_id"] == 50
    assert out[101]["dw_customer_id"] == 60 and out[101]["dw_order_id"] == 2
    assert 102 not in out


def test_manager_same_batch_and_orphan_employee(spark):
    spec = SCD1_SPECS["employees"]
    empty = spark.createDataFrame([], ", ".join(
        f"{c} {'string' if c in ('lastname', 'firstname', 'extension', 'email', 'officecode', 'jobtitle') else 'timestamp_ntz' if 'timestamp' in c else 'date' if c == 'etl_batch_date' else 'int' if c == 'etl_batch_no' else 'bigint'}"
        for c in spec.columns))
    offices = spark.createDataFrame([(1, "1")], "dw_office_id bigint, officecode string")
    stage = spark.createDataFrame([
        (10, "Boss", "B", "x", "e", "1", None, "Mgr", ts(D), ts(D)),
        (11, "Rep", "R", "x", "e", "9", 10, "Rep", ts(D), ts(D)),
    ], SOURCE_SCHEMAS["employees"])
    out = {r["employeenumber"]: r for r in scd1_merge(empty, stage, spec, B, {"offices": offices}).collect()}
    assert out[11]["dw_reporting_employee_id"] is None  # manager arrived in the same batch
    assert out[11]["dw_office_id"] is None and out[10]["dw_office_id"] == 1  # orphan kept


def test_empty_stage_changes_nothing(spark):
    target = _pl_target(spark, [(1, "A", "t", None, None, TS, TS, TS, TS, 6, OLD)])
    out = scd1_merge(target, _pl_stage(spark, []), PL, B).collect()
    assert [tuple(r) for r in out] == [tuple(r) for r in target.collect()]


def test_merge_counts(spark):
    from nightshift.operators.scd1 import merge_counts

    target = _pl_target(spark, [(1, "A", "t", None, None, TS, TS, TS, TS, 6, OLD)])
    stage = _pl_stage(spark, [("A", "u", None, None, TS, ts(D)), ("B", "n", None, None, ts(D), ts(D))])
    row = merge_counts(scd1_merge_parts(target, stage, PL, B), "productlines").first()
    assert (row["updated"], row["inserted"]) == (1, 1)


def test_surrogate_ids_do_not_depend_on_partitions(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 501).alias("k"))
    a = assign_surrogate_keys(df.repartition(3), ["k"], "sid", 10)
    b = assign_surrogate_keys(df.repartition(7), ["k"], "sid", 10)
    ra = sorted((r["k"], r["sid"]) for r in a.collect())
    assert ra == sorted((r["k"], r["sid"]) for r in b.collect())
    assert [s for _, s in ra] == list(range(11, 511))


# --- I9-I10: type-2 -----------------------------------------------------------------------

def test_scd2_changes_nulls_and_first_load(spark):
    spec = SCD2_SPECS["customer_history"]
    hist = spark.createDataFrame(
        [(i, v, OLD, None, 1, TS, TS, 6, OLD, None, None) for i, v in
         [(1, Decimal("10.00")), (2, Decimal("10.00")), (3, None), (4, Decimal("10.00")), (5, None)]],
        "dw_customer_id bigint, creditlimit decimal(12,2), effective_from_date date, "
        "effective_to_date date, dw_active_record_ind int, dw_create_timestamp timestamp_ntz, "
        "dw_update_timestamp timestamp_ntz, create_etl_batch_no int, create_etl_batch_date date, "
        "update_etl_batch_no int, update_etl_batch_date date")
    dim = spark.createDataFrame([(1, Decimal("20.00")), (2, None), (3, Decimal("5.00")),
                                 (4, Decimal("10.00")), (5, None), (6, Decimal("1.00"))],
                                "dw_customer_id bigint, creditlimit decimal(12,2)")
    out = scd2_merge(hist, dim, spec, B).collect()
    closed = sorted(r["dw_customer_id"] for r in out if r["dw_active_record_ind"] == 0)
    assert closed == [1, 2, 3]
    assert all(r["effective_to_date"] == D - dt.timedelta(days=1) for r in out if r["dw_active_record_ind"] == 0)
    active = {}
    for r in out:
        if r["dw_active_record_ind"] == 1:
            assert r["dw_customer_id"] not in active
            active[r["dw_customer_id"]] = r
    assert sorted(active) == [1, 2, 3, 4, 5, 6]
    assert active[6]["effective_from_date"] == D and active[6]["update_etl_batch_no"] is None
    assert active[4]["effective_from_date"] == OLD


# --- I11-I12: daily ------------------------------------------------------------------------

def _wh(spark, orders, details, payments=(), customers=(), products=((1, "9.00"), (2, "5.00"))):
    o = spark.createDataFrame(orders, "dw_order_id bigint, dw_customer_id bigint, orderdate date, "
                                      "shippeddate date, cancelleddate date, status string")
    d = spark.createDataFrame([(a, b, c, Decimal(p)) for a, b, c, p in details],
                              "dw_order_id bigint, dw_product_id bigint, quantityordered int, priceeach decimal(12,2)")
    p = spark.createDataFrame([(a, Decimal(b)) for a, b in products], "dw_product_id bigint, msrp decimal(12,2)")
    pay = spark.createDataFrame([(a, b, Decimal(c)) for a, b, c in payments],
                                "dw_customer_id bigint, paymentdate date, amount decimal(12,2)")
    c = spark.createDataFrame(list(customers), "dw_customer_id bigint, src_create_timestamp timestamp_ntz")
    return {"orders": o, "orderdetails": d, "products": p, "payments": pay, "customers": c}


def _both(wh):
    a = daily.daily_customer_summary(wh, B)
    b = daily.daily_customer_summary_by_branches(wh, B)
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb
    return {(r["summary_date"], r["dw_customer_id"]): r for r in a.collect()}


def test_two_orders_same_product_and_no_details(spark):
    wh = _wh(spark, [(1, 7, D, None, None, "In Process"), (2, 7, D, None, None, "In Process"),
                     (3, 8, D, None, None, "In Process")],
             [(1, 1, 2, "3.00"), (2, 1, 1, "3.00")])
    out = _both(wh)
    r = out[(D, 7)]
    assert (r["order_count"], r["products_items_qty"], r["products_ordered_qty"]) == (2, 1, 3)
    assert r["order_cost_amount"] == Decimal("9.00") and r["order_mrp_amount"] == Decimal("27.00")
    assert (D, 8) not in out  # an order without details leaves no row


def test_cancelled_needs_status_for_customers_not_products(spark):
    wh = _wh(spark, [(1, 7, OLD, None, D, "In Process"), (2, 7, OLD, None, D, " CANCELLED ")],
             [(1, 1, 1, "2.00"), (2, 2, 1, "3.00")])
    c = _both(wh)[(D, 7)]
    assert (c["cancelled_order_count"], c["cancelled_order_amount"]) == (1, Decimal("3.00"))
    p = {r["dw_product_id"]: r for r in daily.daily_product_summary(wh, B).collect()}
    assert sorted(p) == [1, 2] and p[1]["cancelled_order_apd"] == 1
    ref = sorted(map(tuple, daily.daily_product_summary_by_branches(wh, B).collect()))
    assert sorted(map(tuple, daily.daily_product_summary(wh, B).collect())) == ref


def test_first_payment_before_cutoff_and_paid_ordered_same_day(spark):
    wh = _wh(spark, [(1, 7, D, None, None, "x")], [(1, 1, 1, "1.00")],
             payments=[(7, D, "5.00"), (8, OLD, "1.00"), (8, D, "2.00"), (9, D, "4.00")])
    out = _both(wh)
    assert out[(D, 7)]["order_apd"] == 1 and out[(D, 7)]["payment_apd"] == 1
    assert out[(D, 7)]["new_customer_paid_apd"] == 1
    assert out[(D, 8)]["new_customer_paid_apd"] == 0
    assert out[(D, 8)]["payment_amount"] == Decimal("2.00")


def test_shipped_and_new_customers(spark):
    wh = _wh(spark, [(1, 7, OLD, D, None, " Shipped")], [(1, 1, 2, "1.50")],
             customers=[(7, ts(D)), (8, ts(OLD))])
    out = _both(wh)
    r = out[(D, 7)]
    assert (r["shipped_order_count"], r["shipped_order_amount"], r["new_customer_apd"]) == (1, Decimal("3.00"), 1)
    assert r["order_apd"] == 0 and len(out) == 1


# --- I13-I14: monthly -------------------------------------------------------------------------

def test_monthly_update_sticky_and_null(spark):
    key, M = "dw_customer_id", DAILY_CUSTOMER_MEASURES
    month = dt.date(2001, 6, 1)
    names = [n for n, _ in M]

    def mrow(**kw):
        vals = {n: 0 for n in names}
        vals.update(kw)
        return vals

    from nightshift.operators.rollforward import monthly_columns
    cols = monthly_columns(key, M)
    base = mrow(order_count=1, order_apd=1, order_cost_amount=None)
    mon_vals = {**base, "order_apm": 1, "cancelled_order_apm": 0, "shipped_order_apm": 0,
                "payment_apm": 0, "new_customer_apm": 0, "new_customer_paid_apm": 0}
    monthly = spark.createDataFrame(
        [tuple([month, 7] + [mon_vals[c] if mon_vals[c] is None or not c.endswith("_amount") else Decimal(mon_vals[c]) for c in cols[2:-4]] + [TS, TS, 6, OLD])],
        ", ".join(f"{c} {'date' if c in ('start_of_the_month_date', 'etl_batch_date') else 'timestamp_ntz' if 'timestamp' in c else 'int' if c.endswith(('_apd', '_apm')) or c == 'etl_batch_no' else 'decimal(38,2)' if c.endswith('_amount') else 'bigint'}" for c in cols))
    drows = []
    for day, pay in ((D, 1), (D + dt.timedelta(days=1), 0), (dt.date(2001, 7, 2), 1)):
        v = mrow(order_count=2, order_apd=0, payment_apd=pay, payment_amount=5, order_cost_amount=5)
        drows.append(tuple([day, 7] + [Decimal(v[n]) if n.endswith("_amount") else v[n] for n in names] + [B.run_ts, B.run_ts, 7, D]))
    dschema = ", ".join([f"summary_date date, {key} bigint"] + [
        f"{n} {'int' if n.endswith('_apd') else 'decimal(38,2)' if n.endswith('_amount') else 'bigint'}" for n in names
    ] + ["dw_create_timestamp timestamp_ntz, dw_update_timestamp timestamp_ntz, etl_batch_no int, etl_batch_date date"])
    dly = spark.createDataFrame(drows, dschema)
    out = {r["start_of_the_month_date"]: r for r in rollforward_merge(monthly, dly, key, M, B).collect()}
    june = out[month]
    assert june["order_count"] == 5          # 1 + 2 + 2: both daily rows added
    assert june["order_apd"] == 1 and june["order_apm"] == 1   # sticky
    assert june["payment_apm"] == 1 and june["order_cost_amount"] is None  # NULL + x
    assert june["etl_batch_no"] == 7 and june["dw_create_timestamp"] == TS
    july = out[dt.date(2001, 7, 1)]
    assert july["order_count"] == 2 and july["payment_apm"] == 1 and july["dw_create_timestamp"] == B.run_ts


# --- A5-A7: batch log --------------------------------------------------------------------------

def test_log_start_end_twice(spark):
    ctl = spark.createDataFrame([(1, OLD), (2, D)], "etl_batch_no int, etl_batch_date date")
    cur = control.current_batch(ctl)
    empty = spark.createDataFrame([], control.LOG_SCHEMA)
    started = control.log_start(empty, cur, B.run_ts)
    assert [r["etl_batch_status"] for r in started.collect()] == ["R"]
    ended = control.log_end(control.log_end(started, cur, B.run_ts), cur, B.run_ts)
    rows = ended.collect()
    assert len(rows) == 1 and rows[0]["etl_batch_status"] == "S" and rows[0]["etl_batch_no"] == 2


@pytest.mark.parametrize("kind", ["customer", "product"])
def test_one_pass_equals_branches_on_test_tables(spark, sf, kind):
    from nightshift.sources import adapters as A

    wh = A.fact_inputs(spark, sf)
    if kind == "customer":
        a, b = daily.daily_customer_summary(wh, A.BATCH), daily.daily_customer_summary_by_branches(wh, A.BATCH)
    else:
        a, b = daily.daily_product_summary(wh, A.BATCH), daily.daily_product_summary_by_branches(wh, A.BATCH)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_manager_same_batch_resolved_when_asked(spark):
    spec = SCD1_SPECS["employees"]
    types = {c: ("string" if c in ("lastname", "firstname", "extension", "email", "officecode", "jobtitle")
                 else "timestamp_ntz" if "timestamp" in c else "date" if c == "etl_batch_date"
                 else "int" if c == "etl_batch_no" else "bigint") for c in spec.columns}
    empty = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))
    offices = spark.createDataFrame([(1, "1")], "dw_office_id bigint, officecode string")
    stage = spark.createDataFrame([
        (10, "Boss", "B", "x", "e", "1", None, "Mgr", ts(D), ts(D)),
        (11, "Rep", "R", "x", "e", "1", 10, "Rep", ts(D), ts(D)),
    ], SOURCE_SCHEMAS["employees"])
    parts = scd1_merge_parts(empty, stage, spec, B, {"offices": offices}, resolve_within_batch=True)
    out = {r["employeenumber"]: r for r in parts.table.collect()}
    assert out[11]["dw_reporting_employee_id"] == out[10]["dw_employee_id"] == 1


def test_daily_with_no_events_is_empty(spark):
    wh = _wh(spark, [(1, 7, OLD, None, None, "x")], [(1, 1, 1, "1.00")],
             payments=[(7, OLD, "5.00")], customers=[(7, ts(OLD))])
    assert daily.daily_customer_summary(wh, B).count() == 0
    assert daily.daily_product_summary(wh, B).count() == 0
