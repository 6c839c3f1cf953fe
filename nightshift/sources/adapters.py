"""Test-table adapters: the driver's TPC-H-like tables as the retail source.

The reference ships no data, so the source system and the warehouse state
before a batch are derived, deterministically and in full, from the given
tables (FIXTURES.md §3).  Creation and update days are functions of the
natural key; the batch then picks its change set by the reference's own rule,
update day >= batch date.  Nothing is sampled: every row of every given
table is read and lands in the source, the previous warehouse state or both.

Three views per table:

* ``source(t)``   - the source system as of the batch (current values).
* ``previous(t)`` - the warehouse after the previous batch: rows created
                    before the batch date, with their values as they were
                    before this batch's changes.
* ``current(t)``  - the warehouse as of this batch, all rows, current values;
                    used by the fact programs (daily, monthly, history).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.schemas import MONEY

# --- fixed values of the scenario ------------------------------------------
EPOCH = dt.date(1995, 1, 1)
BATCH = Batch(no=2358, date=dt.date(2001, 6, 15), run_ts=dt.datetime(2001, 6, 16, 2, 0, 0))
PREV_BATCH = Batch(no=2357, date=dt.date(2001, 6, 14), run_ts=dt.datetime(2001, 6, 15, 2, 0, 0))
BATCH_DAY = (BATCH.date - EPOCH).days  # 2357
END_TS = dt.datetime(2001, 6, 16, 3, 30, 0)
# Day rules: creation day = (key * a) % 2400, update day = creation day + (key * b) % c.
CUSTOMER_DAYS = (37, 11, 400)
EMPLOYEE_DAYS = (53, 7, 300)
PRODUCT_DAYS = (29, 13, 500)
NEW_OFFICE_FROM = 23  # nation keys >= 23 open their office in this batch
# ---------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(days: Column) -> Column:
    return F.date_add(F.lit(EPOCH), days.cast("int"))


def _at(date_col: Column, hours: int) -> Column:
    return date_col.cast("timestamp_ntz") + F.expr(f"INTERVAL {hours} HOURS")


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def created_day(key: Column, rule: tuple[int, int, int]) -> Column:
    return (key * rule[0]) % 2400


def updated_day(key: Column, rule: tuple[int, int, int]) -> Column:
    return created_day(key, rule) + (key * rule[1]) % rule[2]


def _before(day_col: Column) -> Column:
    """The creation day (days since the epoch) falls before the batch date."""
    return _d(day_col) < F.lit(BATCH.date)


# --- source system -----------------------------------------------------------

def source_customers(spark, sf):
    c = read(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("customernumber"),
        F.col("c_name").alias("customername"),
        F.col("c_mktsegment").alias("contactlastname"),
        F.concat(F.lit("Contact "), _s(k)).alias("contactfirstname"),
        F.concat(_s("c_nationkey"), F.lit("-"), _s(k)).alias("phone"),
        F.concat(F.lit("Street "), _s(k)).alias("addressline1"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 1, F.lit(""))
        .when(k % 4 == 2, F.lit("  "))
        .otherwise(F.concat(F.lit(" Suite "), _s(k), F.lit(" ")))
        .alias("addressline2"),
        F.concat(F.lit("City "), _s("c_nationkey")).alias("city"),
        F.lit(None).cast("string").alias("state"),
        _s(k + 10000).alias("postalcode"),
        F.concat(F.lit("N"), _s("c_nationkey")).alias("country"),
        F.when(k % 7 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.col("c_nationkey").cast("bigint"))
        .alias("salesrepemployeenumber"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast(MONEY))
        .otherwise(_money(F.col("c_acctbal")))
        .alias("creditlimit"),
        _at(_d(created_day(k, CUSTOMER_DAYS)), 9).alias("create_timestamp"),
        _at(_d(updated_day(k, CUSTOMER_DAYS)), 17).alias("update_timestamp"),
    )


UNKNOWN_OFFICE = "999"


def source_employees(spark, sf):
    s = read(spark, sf, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("employeenumber"),
        F.col("s_name").alias("lastname"),
        F.concat(F.lit("E"), _s(k)).alias("firstname"),
        F.concat(F.lit("x"), _s(k + 100)).alias("extension"),
        F.concat(F.lit("e"), _s(k), F.lit("@example.com")).alias("email"),
        # Every third office is unknown, every fourth employee has no manager.
        F.when(k % 3 == 1, F.lit(UNKNOWN_OFFICE)).otherwise(_s("s_nationkey")).alias("officecode"),
        F.when((k == 0) | (k % 4 == 2), F.lit(None).cast("bigint")).otherwise(F.floor(k / 10).cast("bigint"))
        .alias("reportsto"),
        F.when(k < 10, F.lit("Sales Manager")).otherwise(F.lit("Sales Rep")).alias("jobtitle"),
        _at(_d(created_day(k, EMPLOYEE_DAYS)), 9).alias("create_timestamp"),
        _at(_d(updated_day(k, EMPLOYEE_DAYS)), 17).alias("update_timestamp"),
    )


def _office_days(nk: Column) -> tuple[Column, Column]:
    created = F.when(nk >= NEW_OFFICE_FROM, F.lit(BATCH_DAY + 3)).otherwise(nk * 3)
    updated = F.when(nk % 5 == 0, F.lit(BATCH_DAY + 1)).otherwise(created)
    return created, updated


def source_offices(spark, sf):
    n = read(spark, sf, "nation")
    from nightshift.operators.joins import bounded_broadcast

    r = bounded_broadcast(read(spark, sf, "region"))
    nk = F.col("n_nationkey")
    created, updated = _office_days(nk)
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        _s(nk).alias("officecode"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("+1 "), _s(nk)).alias("phone"),
        F.concat(F.lit("Office "), _s(nk)).alias("addressline1"),
        F.lit(None).cast("string").alias("addressline2"),
        F.lit(None).cast("string").alias("state"),
        F.col("n_name").alias("country"),
        _s(nk + 1000).alias("postalcode"),
        F.col("r_name").alias("territory"),
        _at(_d(created), 9).alias("create_timestamp"),
        _at(_d(updated), 17).alias("update_timestamp"),
    )


def source_productlines(spark, sf):
    lines = read(spark, sf, "part").select(F.col("p_type").alias("productline")).distinct()
    pl = F.col("productline")
    return lines.select(
        pl,
        F.concat(F.lit("Line "), pl).alias("textdescription"),
        F.concat(F.lit("<b>"), pl, F.lit("</b>")).alias("htmldescription"),
        F.lit(None).cast("string").alias("image"),
        _at(F.lit(EPOCH), 6).alias("create_timestamp"),
        _at(F.when(F.length(pl) == 5, _d(F.lit(BATCH_DAY + 1))).otherwise(F.lit(EPOCH)), 7)
        .alias("update_timestamp"),
    )


def source_products(spark, sf):
    p = read(spark, sf, "part")
    k = F.col("p_partkey")
    return p.select(
        _s(k).alias("productcode"),
        F.col("p_name").alias("productname"),
        F.col("p_type").alias("productline"),
        F.concat(F.lit("1:"), _s("p_size")).alias("productscale"),
        F.col("p_brand").alias("productvendor"),
        F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand")).alias("productdescription"),
        (F.col("p_size") * 10).cast("int").alias("quantityinstock"),
        _money(_money(F.col("p_retailprice")) - 50).alias("buyprice"),
        _money(F.col("p_retailprice")).alias("msrp"),
        _at(_d(created_day(k, PRODUCT_DAYS)), 9).alias("create_timestamp"),
        _at(_d(updated_day(k, PRODUCT_DAYS)), 17).alias("update_timestamp"),
    )


def _order_cols(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("date")
    shipped = F.when(F.col("o_orderstatus") == "F", F.date_add(od, (k % 7).cast("int")))
    cancelled = F.when(F.col("o_orderstatus") == "P", F.date_add(od, (k % 4).cast("int")))
    last = F.greatest(od, F.coalesce(shipped, od), F.coalesce(cancelled, od))
    return o.select(
        k.alias("ordernumber"),
        od.alias("orderdate"),
        F.date_add(od, 10).alias("requireddate"),
        shipped.alias("shippeddate"),
        F.when(F.col("o_orderstatus") == "F", F.lit(" Shipped"))
        .when((F.col("o_orderstatus") == "P") & (k % 2 == 0), F.lit("CANCELLED "))
        .otherwise(F.lit("In Process"))
        .alias("status"),
        F.col("o_orderpriority").alias("comments"),
        F.col("o_custkey").alias("customernumber"),
        cancelled.alias("cancelleddate"),
        _at(od, 8).alias("create_timestamp"),
        _at(last, 18).alias("update_timestamp"),
    )


def source_orders(spark, sf):
    return _order_cols(read(spark, sf, "orders"))


def _order_lines(spark, sf, order: str, product: str, shift: int):
    """The source's order lines by ``order`` and ``product`` (their numbers + ``shift``), with their order's timestamps.

    Line items are dealt by the order once: the sums, the join with the
    orders and every later join on ``order`` find them where they are.  The
    keys are made first, so that a semi join on them can go below the sums.
    """
    from nightshift.operators.joins import dealt

    def key(c: str) -> Column:
        return F.col(c).cast("bigint") + shift if shift else F.col(c)

    items = read(spark, sf, "lineitem")
    rows = items.count()  # from the files' footers
    keyed = items.select(
        key("l_orderkey").alias(order), key("l_partkey").alias(product), "l_quantity", "l_extendedprice", "l_linenumber"
    )
    lines = (
        dealt(keyed, rows, order)
        .groupBy(order, product)
        .agg(
            F.sum("l_quantity").cast("int").alias("quantityordered"),
            _money(F.max("l_extendedprice")).alias("priceeach"),
            F.min("l_linenumber").alias("orderlinenumber"),
        )
    )
    # Details travel with their order: created with it, re-sent when it changes.
    orders = source_orders(spark, sf).select(key("ordernumber").alias(order), "create_timestamp", "update_timestamp")
    return lines.join(orders, order, "inner")


def source_orderdetails(spark, sf):
    return _order_lines(spark, sf, "ordernumber", "partkey", 0).select(
        "ordernumber",
        _s("partkey").alias("productcode"),
        "quantityordered",
        "priceeach",
        "orderlinenumber",
        "create_timestamp",
        "update_timestamp",
    )


def source_payments(spark, sf):
    o = read(spark, sf, "orders")
    k = F.col("o_orderkey")
    paid = F.date_add(F.col("o_orderdate").cast("date"), (k % 11).cast("int"))
    return o.select(
        F.col("o_custkey").alias("customernumber"),
        F.concat(F.lit("CHK"), _s(k)).alias("checknumber"),
        paid.alias("paymentdate"),
        _money(F.col("o_totalprice")).alias("amount"),
        _at(paid, 12).alias("create_timestamp"),
        _at(F.date_add(paid, (k % 45).cast("int")), 12).alias("update_timestamp"),
    )


SOURCES = {
    "offices": source_offices,
    "employees": source_employees,
    "customers": source_customers,
    "productlines": source_productlines,
    "products": source_products,
    "orders": source_orders,
    "orderdetails": source_orderdetails,
    "payments": source_payments,
}


def source(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return SOURCES[table](spark, sf)


def source_before(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """The source table as it was before the scenario's batch.

    Rows created since are absent; rows updated since stand as created, with
    the tracked value (credit limit, list price) they had then.
    """
    changed = F.to_date("update_timestamp") >= F.lit(BATCH.date)
    df = source(spark, sf, table).where(F.to_date("create_timestamp") < F.lit(BATCH.date))
    tracked = {"customers": "creditlimit", "products": "msrp"}.get(table)
    if tracked:
        kind = df.schema[tracked].dataType
        df = df.withColumn(tracked, F.when(changed, F.col(tracked) - 100).otherwise(F.col(tracked)).cast(kind))
    return df.withColumn("update_timestamp", F.when(changed, F.col("create_timestamp")).otherwise(F.col("update_timestamp")))


# --- warehouse before the batch -------------------------------------------

def _prev_audit(changed: Column) -> list[Column]:
    src_upd = F.when(changed, F.col("create_timestamp")).otherwise(F.col("update_timestamp"))
    return [
        F.col("create_timestamp").alias("src_create_timestamp"),
        src_upd.alias("src_update_timestamp"),
        F.col("create_timestamp").alias("dw_create_timestamp"),
        src_upd.alias("dw_update_timestamp"),
        PREV_BATCH.no_col.alias("etl_batch_no"),
        PREV_BATCH.date_col.alias("etl_batch_date"),
    ]


def _changed_now(ts: str = "update_timestamp") -> Column:
    return F.col(ts).cast("date") >= F.lit(BATCH.date)


def _created_before(ts: str = "create_timestamp") -> Column:
    return F.col(ts).cast("date") < F.lit(BATCH.date)


def previous_offices(spark, sf):
    s = source_offices(spark, sf).where(_created_before())
    ch = _changed_now()
    return s.select(
        (F.col("officecode").cast("bigint") + 1).alias("dw_office_id"),
        "officecode", "city", "phone", "addressline1", "addressline2", "state",
        "country", "postalcode",
        F.when(ch, F.lit("UNASSIGNED")).otherwise(F.col("territory")).alias("territory"),
        *_prev_audit(ch),
    )


def previous_employees(spark, sf):
    s = source_employees(spark, sf).where(_created_before())
    ch = _changed_now()
    mgr = F.col("reportsto")
    mgr_known = _before(created_day(mgr, EMPLOYEE_DAYS))
    office_known = F.col("officecode").cast("int") < NEW_OFFICE_FROM
    return s.select(
        (F.col("employeenumber") + 1).alias("dw_employee_id"),
        "employeenumber", "lastname", "firstname", "extension", "email", "officecode",
        "reportsto",
        F.when(ch, F.lit("Trainee")).otherwise(F.col("jobtitle")).alias("jobtitle"),
        F.when(office_known, F.col("officecode").cast("bigint") + 1).alias("dw_office_id"),
        F.when(mgr_known, mgr + 1).alias("dw_reporting_employee_id"),
        *_prev_audit(ch),
    )


def previous_customers(spark, sf):
    s = source_customers(spark, sf).where(_created_before())
    ch = _changed_now()
    k = F.col("customernumber")
    old_limit = (
        F.when(k % 3 == 0, F.col("creditlimit"))
        .when(k % 3 == 1, _money(F.coalesce(F.col("creditlimit"), F.lit(0)) - 100))
        .otherwise(F.lit(None).cast(MONEY))
    )
    return s.select(
        (k + 1).alias("dw_customer_id"),
        k.alias("src_customernumber"),
        F.when(ch, F.concat(F.col("customername"), F.lit(" (old)")))
        .otherwise(F.col("customername")).alias("customername"),
        "contactlastname", "contactfirstname", "phone", "addressline1",
        F.when(F.trim("addressline2") == "", F.lit(None).cast("string"))
        .otherwise(F.col("addressline2")).alias("addressline2"),
        "city", "state", "postalcode", "country", "salesrepemployeenumber",
        F.when(ch, old_limit).otherwise(F.col("creditlimit")).alias("creditlimit"),
        *_prev_audit(ch),
    )


def previous_productlines(spark, sf):
    s = source_productlines(spark, sf).where(_created_before())
    ch = _changed_now()
    from nightshift.operators.surrogate import assign_surrogate_keys

    ranked = assign_surrogate_keys(s, ["productline"], "dw_product_line_id", 0)
    return ranked.select(
        "dw_product_line_id", "productline",
        F.when(ch, F.lit("Line (draft)")).otherwise(F.col("textdescription"))
        .alias("textdescription"),
        "htmldescription", "image",
        *_prev_audit(ch),
    )


def previous_products(spark, sf):
    s = source_products(spark, sf).where(_created_before())
    ch = _changed_now()
    k = F.col("productcode").cast("bigint")
    old_msrp = (
        F.when(k % 3 == 0, F.col("msrp"))
        .when(k % 3 == 1, _money(F.col("msrp") + 10))
        .otherwise(F.lit(None).cast(MONEY))
    )
    from nightshift.operators.joins import bounded_broadcast

    lines = bounded_broadcast(
        previous_productlines(spark, sf).select("productline", "dw_product_line_id")
    )
    return s.join(lines, "productline", "left").select(
        (k + 1).alias("dw_product_id"),
        F.col("productcode").alias("src_productcode"),
        "productname", "productline", "productscale", "productvendor",
        "productdescription", "quantityinstock", "buyprice",
        F.when(ch, old_msrp).otherwise(F.col("msrp")).alias("msrp"),
        "dw_product_line_id",
        *_prev_audit(ch),
    )


def _customer_known(col: str) -> Column:
    return _before(created_day(F.col(col), CUSTOMER_DAYS))


def previous_orders(spark, sf):
    s = source_orders(spark, sf).where(_created_before() & _customer_known("customernumber"))
    ch = _changed_now()
    return s.select(
        (F.col("ordernumber") + 1).alias("dw_order_id"),
        F.col("ordernumber").alias("src_ordernumber"),
        "orderdate", "requireddate",
        F.when(~ch, F.col("shippeddate")).alias("shippeddate"),
        F.when(ch, F.lit("In Process")).otherwise(F.col("status")).alias("status"),
        "comments",
        F.col("customernumber").alias("src_customernumber"),
        F.when(~ch, F.col("cancelleddate")).alias("cancelleddate"),
        (F.col("customernumber") + 1).alias("dw_customer_id"),
        *_prev_audit(ch),
    )


def previous_orderdetails(spark, sf):
    orders = previous_orders(spark, sf).select(F.col("src_ordernumber").alias("ordernumber"))
    s = source_orderdetails(spark, sf).join(orders, "ordernumber", "left_semi")
    s = s.where(_before(created_day(F.col("productcode").cast("bigint"), PRODUCT_DAYS)))
    ch = _changed_now()
    return s.select(
        (F.col("ordernumber") + 1).alias("dw_order_id"),
        (F.col("productcode").cast("bigint") + 1).alias("dw_product_id"),
        F.col("ordernumber").alias("src_ordernumber"),
        F.col("productcode").alias("src_productcode"),
        "quantityordered", "priceeach", "orderlinenumber",
        *_prev_audit(ch),
    )


def previous_payments(spark, sf):
    s = source_payments(spark, sf).where(_created_before() & _customer_known("customernumber"))
    ch = _changed_now()
    return s.select(
        (F.col("customernumber") + 1).alias("dw_customer_id"),
        F.col("customernumber").alias("src_customernumber"),
        "checknumber", "paymentdate",
        F.when(ch, _money(F.col("amount") + 1)).otherwise(F.col("amount")).alias("amount"),
        *_prev_audit(ch),
    )


PREVIOUS = {
    "offices": previous_offices,
    "employees": previous_employees,
    "customers": previous_customers,
    "productlines": previous_productlines,
    "products": previous_products,
    "orders": previous_orders,
    "orderdetails": previous_orderdetails,
    "payments": previous_payments,
}


def previous(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return PREVIOUS[table](spark, sf)


# --- warehouse as of the batch (fact inputs) --------------------------------

def _cur_audit() -> list[Column]:
    return [
        F.col("create_timestamp").alias("src_create_timestamp"),
        F.col("update_timestamp").alias("src_update_timestamp"),
        F.col("create_timestamp").alias("dw_create_timestamp"),
        F.col("update_timestamp").alias("dw_update_timestamp"),
        BATCH.no_col.alias("etl_batch_no"),
        BATCH.date_col.alias("etl_batch_date"),
    ]


def current_customers(spark, sf):
    s = source_customers(spark, sf)
    return s.select(
        (F.col("customernumber") + 1).alias("dw_customer_id"),
        F.col("customernumber").alias("src_customernumber"),
        "customername", "contactlastname", "contactfirstname", "phone", "addressline1",
        F.when(F.trim("addressline2") == "", F.lit(None).cast("string"))
        .otherwise(F.col("addressline2")).alias("addressline2"),
        "city", "state", "postalcode", "country", "salesrepemployeenumber", "creditlimit",
        *_cur_audit(),
    )


def current_products(spark, sf):
    s = source_products(spark, sf)
    k = F.col("productcode").cast("bigint")
    return s.select(
        (k + 1).alias("dw_product_id"),
        F.col("productcode").alias("src_productcode"),
        "productname", "productline", "productscale", "productvendor",
        "productdescription", "quantityinstock", "buyprice", "msrp",
        *_cur_audit(),
    )


def current_orders(spark, sf):
    s = source_orders(spark, sf)
    return s.select(
        (F.col("ordernumber") + 1).alias("dw_order_id"),
        F.col("ordernumber").alias("src_ordernumber"),
        "orderdate", "requireddate", "shippeddate", "status", "comments",
        F.col("customernumber").alias("src_customernumber"),
        "cancelleddate",
        (F.col("customernumber") + 1).alias("dw_customer_id"),
        *_cur_audit(),
    )


def current_orderdetails(spark, sf):
    # By the warehouse's ids, on which the facts join lines with orders.
    s = _order_lines(spark, sf, "dw_order_id", "dw_product_id", 1)
    return s.select(
        "dw_order_id",
        "dw_product_id",
        (F.col("dw_order_id") - 1).alias("src_ordernumber"),
        _s(F.col("dw_product_id") - 1).alias("src_productcode"),
        "quantityordered", "priceeach", "orderlinenumber",
        *_cur_audit(),
    )


def current_payments(spark, sf):
    s = source_payments(spark, sf)
    return s.select(
        (F.col("customernumber") + 1).alias("dw_customer_id"),
        F.col("customernumber").alias("src_customernumber"),
        "checknumber", "paymentdate", "amount",
        *_cur_audit(),
    )


CURRENT = {
    "customers": current_customers,
    "products": current_products,
    "orders": current_orders,
    "orderdetails": current_orderdetails,
    "payments": current_payments,
}


def current(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return CURRENT[table](spark, sf)


def fact_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: current(spark, sf, t) for t in CURRENT}


# --- stage, control, history and fact-table fixtures ---------------------------

def stage(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """The staged change set: A1 extract of the source + A4 blanks -> NULL."""
    from nightshift.sources.extract import blanks_as_null, extract_incremental

    return blanks_as_null(extract_incremental(source(spark, sf, table), table, BATCH.date))


def batch_control(spark: SparkSession, sf: str, upto: dt.date | None = None) -> DataFrame:
    """One batch per order day; ``upto`` gives the table as it was on that day."""
    days = read(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("etl_batch_date")).distinct()
    if upto is not None:
        days = days.where(F.col("etl_batch_date") <= F.lit(upto))
    return days.select(
        (F.datediff("etl_batch_date", F.lit(EPOCH)) + 1).cast("int").alias("etl_batch_no"),
        "etl_batch_date",
    )


def previous_log(spark: SparkSession, sf: str) -> DataFrame:
    """The log before the last batch: every earlier batch ran and succeeded."""
    bc = batch_control(spark, sf)
    last = bc.agg(F.max("etl_batch_date")).first()[0]
    bc = bc.where(F.col("etl_batch_date") < F.lit(last))
    nxt = F.date_add("etl_batch_date", 1)
    return bc.select(
        "etl_batch_no",
        "etl_batch_date",
        F.lit("S").alias("etl_batch_status"),
        _at(nxt, 2).alias("etl_batch_start_time"),
        _at(nxt, 3).alias("etl_batch_end_time"),
    )


def previous_history(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """History before the batch: an active version per known dimension row,
    and for every fourth one a closed version before it."""
    from nightshift.schemas import SCD2_SPECS

    spec = SCD2_SPECS[name]
    dim = previous(spark, sf, spec.dim)
    since = F.col("src_create_timestamp").cast("date")

    def version(rows, value, begin, end, active, update_no, update_date):
        return rows.select(
            spec.id_col,
            value.alias(spec.tracked),
            begin.alias("effective_from_date"),
            end.cast("date").alias("effective_to_date"),
            F.lit(active).alias("dw_active_record_ind"),
            F.col("src_create_timestamp").alias("dw_create_timestamp"),
            F.col("src_create_timestamp").alias("dw_update_timestamp"),
            PREV_BATCH.no_col.alias("create_etl_batch_no"),
            begin.alias("create_etl_batch_date"),
            update_no.cast("int").alias("update_etl_batch_no"),
            update_date.cast("date").alias("update_etl_batch_date"),
        )

    none = F.lit(None)
    tracked = F.col(spec.tracked)
    older = (tracked - 25).cast(dim.schema[spec.tracked].dataType)
    active = version(dim, tracked, since, none, 1, none, none)
    closed = version(dim.where(F.col(spec.id_col) % 4 == 0), older, F.date_sub(since, 30),
                     F.date_sub(since, 1), 0, PREV_BATCH.no_col, since)
    return active.unionByName(closed)


def _restamp(df: DataFrame) -> DataFrame:
    """Rows before the batch date were written by the previous batch."""
    old = F.col("summary_date") < F.lit(BATCH.date)
    return df.withColumns({
        "dw_create_timestamp": F.when(old, PREV_BATCH.ts_col).otherwise(BATCH.ts_col),
        "dw_update_timestamp": F.when(old, PREV_BATCH.ts_col).otherwise(BATCH.ts_col),
        "etl_batch_no": F.when(old, PREV_BATCH.no_col).otherwise(BATCH.no_col),
        "etl_batch_date": F.when(old, PREV_BATCH.date_col).otherwise(BATCH.date_col),
    })


FULL_HISTORY = Batch(no=BATCH.no, date=EPOCH, run_ts=BATCH.run_ts)


def daily_table(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The daily summary table after this batch: every day since the epoch."""
    from nightshift.plans import daily

    from nightshift.session import materialize

    fn = daily.daily_customer_summary if kind == "customer" else daily.daily_product_summary
    # A stored table in the warehouse: written once to the shared scratch
    # folder, so the monthly programs read the columns they use instead of
    # recomputing the whole history for each use.
    return materialize(_restamp(fn(fact_inputs(spark, sf), FULL_HISTORY)))


def previous_monthly(spark: SparkSession, sf: str, kind: str,
                     daily_rows: DataFrame | None = None) -> DataFrame:
    """The monthly table before this batch: months of the days before it."""
    from nightshift.operators.rollforward import rollup_months
    from nightshift.schemas import DAILY_CUSTOMER_MEASURES, DAILY_PRODUCT_MEASURES

    key, measures = (("dw_customer_id", DAILY_CUSTOMER_MEASURES) if kind == "customer"
                     else ("dw_product_id", DAILY_PRODUCT_MEASURES))
    d = daily_rows if daily_rows is not None else daily_table(spark, sf, kind)
    d = d.where(F.col("summary_date") < F.lit(BATCH.date))
    return rollup_months(d, key, measures, PREV_BATCH)
