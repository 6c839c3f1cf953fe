"""Registry of named queries (one per SURVEY §2 operator / program).

Each entry takes ``(spark, sf_dir)``, builds the adapter views from the
given tables and returns a DataFrame.  ``as_compared`` turns exact money
(DECIMAL) into DOUBLE at the very end, as the oracle does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshift.functions import (
    blank_as_null, changed, day, day_before, month_start, normalized, sticky_flag,
)
from nightshift.operators import scd2 as _scd2
from nightshift.operators.joins import lookup, new_keys
from nightshift.plans import daily, programs
from nightshift.plans.tables import empty_table
from nightshift.schemas import (
    DAILY_CUSTOMER_MEASURES, SCD1_ORDER, SCD1_SPECS, SCD2_SPECS, SOURCE_SCHEMAS, SOURCE_TABLES,
)
from nightshift.session import scratch_path
from nightshift.sources import adapters as A
from nightshift.sources import control, extract

Query = Callable[[SparkSession, str], DataFrame]


def as_compared(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _compared(fn: Callable[[SparkSession, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return as_compared(fn(spark, sf))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = _compared(fn)
        return fn

    return deco


# --- I11 / I12 daily summaries ----------------------------------------------

@register("daily_customer_summary")
def q_daily_customer_summary(spark, sf):
    return daily.daily_customer_summary(A.fact_inputs(spark, sf), A.BATCH)


@register("daily_product_summary")
def q_daily_product_summary(spark, sf):
    return daily.daily_product_summary(A.fact_inputs(spark, sf), A.BATCH)


def _customer_branch(name):
    def q(spark, sf):
        return daily.CUSTOMER_BRANCHES[name](A.fact_inputs(spark, sf), A.BATCH)

    q.__name__ = f"q_daily_customer_{name}"
    return q


def _product_branch(name):
    def q(spark, sf):
        return daily.PRODUCT_BRANCHES[name](A.fact_inputs(spark, sf), A.BATCH)

    q.__name__ = f"q_daily_product_{name}"
    return q


for _b in daily.CUSTOMER_BRANCHES:
    register(f"daily_customer_{_b}")(_customer_branch(_b))
for _b in daily.PRODUCT_BRANCHES:
    register(f"daily_product_{_b}")(_product_branch(_b))


# --- I1-I8 type-1 upserts, I15 counts, I16 surrogate keys -------------------


def _merge_inputs(spark, sf, table):
    spec = SCD1_SPECS[table]
    wh = {table: A.previous(spark, sf, table)}
    for lk in spec.lookups:
        if not lk.self_ref:
            wh[lk.parent] = A.previous(spark, sf, lk.parent)
    return wh, A.stage(spark, sf, table)


def _upsert_query(table):
    def q(spark, sf):
        wh, st = _merge_inputs(spark, sf, table)
        return programs.upsert(table, wh, st, A.BATCH)

    q.__name__ = f"q_upsert_{table}"
    q.__doc__ = f"I: type-1 merge of the staged {table} into the warehouse table."
    return q


for _t in SCD1_ORDER:
    register(f"upsert_{_t}")(_upsert_query(_t))


@register("merge_counts")
def q_merge_counts(spark, sf):
    """Rows updated and inserted per type-1 table."""
    out = None
    for t in SCD1_ORDER:
        wh, st = _merge_inputs(spark, sf, t)
        part = programs.merge_counts_of(t, wh, st, A.BATCH)
        out = part if out is None else out.unionByName(part)
    return out


@register("surrogate_keys")
def q_surrogate_keys(spark, sf):
    """I16: ids given to the customers inserted by the batch."""
    wh, st = _merge_inputs(spark, sf, "customers")
    fresh = programs.upsert_parts("customers", wh, st, A.BATCH).fresh
    return fresh.select("src_customernumber", "dw_customer_id")


# --- I9-I10 type-2 history ----------------------------------------------------


def _history_inputs(spark, sf, name):
    spec = SCD2_SPECS[name]
    return {name: A.previous_history(spark, sf, name), spec.dim: A.current(spark, sf, spec.dim)}


def _history_query(name, part):
    spec = SCD2_SPECS[name]

    def q(spark, sf):
        wh = _history_inputs(spark, sf, name)
        h, dim = wh[name], wh[spec.dim]
        if part == "all":
            return programs.history(name, wh, A.BATCH)
        if part == "close":
            return _scd2.close_changed(h, dim, spec, A.BATCH).where("dw_active_record_ind = 0")
        return _scd2.rows_to_open(h, dim, spec, A.BATCH)

    q.__name__ = f"q_{name}_{part}"
    return q


for _name, _short in (("customer_history", "customer"), ("product_history", "product")):
    register(f"scd2_{_name}")(_history_query(_name, "all"))
    register(f"scd2_close_{_short}")(_history_query(_name, "close"))
    register(f"scd2_open_{_short}")(_history_query(_name, "open"))


# --- I13-I14 monthly roll-forward ----------------------------------------------

def _monthly_inputs(spark, sf, kind):
    d = A.daily_table(spark, sf, kind)
    return {
        f"monthly_{kind}_summary": A.previous_monthly(spark, sf, kind, d),
        f"daily_{kind}_summary": d,
    }


def _monthly_query(kind, part):
    name = f"monthly_{kind}_summary"

    def q(spark, sf):
        wh = _monthly_inputs(spark, sf, kind)
        if part == "all":
            return programs.monthly(name, wh, A.BATCH)
        updated, inserted = programs.monthly_parts(name, wh, A.BATCH)
        if part == "insert":
            return inserted
        return updated.where(F.col("etl_batch_no") == A.BATCH.no)

    q.__name__ = f"q_{name}_{part}"
    return q


for _k in ("customer", "product"):
    register(f"monthly_{_k}_summary")(_monthly_query(_k, "all"))
    register(f"monthly_update_{_k}")(_monthly_query(_k, "update"))
    register(f"monthly_insert_{_k}")(_monthly_query(_k, "insert"))


# --- A: extract, land, stage, batch control -------------------------------------


def _extract_query(table):
    def q(spark, sf):
        return extract.extract_incremental(A.source(spark, sf, table), table, A.BATCH.date)

    q.__name__ = f"q_extract_incremental_{table}"
    return q


def _own_root(spark, name):
    """A landing root of this call only: a second call never overwrites
    files that an earlier, still unread DataFrame lists."""
    import uuid

    return scratch_path(spark, "queries", name, uuid.uuid4().hex)


def _stage_query(table):
    def q(spark, sf):
        ex = extract.extract_incremental(A.source(spark, sf, table), table, A.BATCH.date)
        path = extract.landing_path(spark, table, A.BATCH.date, root=_own_root(spark, "stage"))
        extract.land(ex, path, fmt="csv")
        return extract.stage_load(spark, table, path, fmt="csv")

    q.__name__ = f"q_stage_load_{table}"
    return q


for _t in SOURCE_TABLES:
    register(f"extract_incremental_{_t}")(_extract_query(_t))
    register(f"stage_load_{_t}")(_stage_query(_t))


@register("landing_roundtrip")
def q_landing_roundtrip(spark, sf):
    """A2: the customers extract through landing CSV and back, unchanged."""
    ex = extract.extract_incremental(A.source(spark, sf, "customers"), "customers", A.BATCH.date)
    path = extract.landing_path(spark, "customers", A.BATCH.date,
                                root=_own_root(spark, "landing_roundtrip"))
    extract.land(ex, path, fmt="csv")
    return (spark.read.schema(SOURCE_SCHEMAS["customers"]).options(**extract.CSV_READ).csv(path))


@register("blanks_as_null")
def q_blanks_as_null(spark, sf):
    """A4: the address line as extracted and as staged."""
    ex = extract.extract_incremental(A.source(spark, sf, "customers"), "customers", A.BATCH.date)
    return ex.select("customernumber", F.col("addressline2").alias("addressline2_raw"),
                     blank_as_null("addressline2").alias("addressline2"))


@register("current_batch")
def q_current_batch(spark, sf):
    """A5 / F1: the batch with the highest number."""
    return control.current_batch(A.batch_control(spark, sf))


@register("batch_log_start")
def q_batch_log_start(spark, sf):
    """The log with the current batch's 'R' row appended."""
    cur = control.current_batch(A.batch_control(spark, sf))
    return control.log_start(A.previous_log(spark, sf), cur, A.BATCH.run_ts)


@register("batch_log_end")
def q_batch_log_end(spark, sf):
    """Start, then end with status 'S'."""
    cur = control.current_batch(A.batch_control(spark, sf))
    started = control.log_start(A.previous_log(spark, sf), cur, A.BATCH.run_ts)
    return control.log_end(started, cur, A.END_TS)


# --- B/C: predicates and joins -------------------------------------------------------

@register("null_safe_change_filter")
def q_null_safe_change_filter(spark, sf):
    """B7 + C10: dimension rows whose tracked value differs from the active version."""
    dim = A.current(spark, sf, "customers").select("dw_customer_id", "creditlimit")
    act = A.previous_history(spark, sf, "customer_history").where("dw_active_record_ind = 1") \
        .select("dw_customer_id", F.col("creditlimit").alias("previous_creditlimit"))
    return dim.join(act, "dw_customer_id").where(changed("creditlimit", "previous_creditlimit"))


@register("join_inner_orders_details")
def q_join_inner_orders_details(spark, sf):
    """Orders x order details."""
    o = A.current(spark, sf, "orders").select("dw_order_id", "dw_customer_id", "orderdate")
    d = A.current(spark, sf, "orderdetails").select("dw_order_id", "dw_product_id",
                                                    "quantityordered", "priceeach")
    return o.join(d, "dw_order_id")


@register("join_inner_three_way")
def q_join_inner_three_way(spark, sf):
    """Orders x order details x products."""
    o = A.current(spark, sf, "orders").select("dw_order_id", "orderdate")
    d = A.current(spark, sf, "orderdetails").select("dw_order_id", "dw_product_id",
                                                    "quantityordered", "priceeach")
    p = A.current(spark, sf, "products").select("dw_product_id", "msrp")
    return o.join(d, "dw_order_id").join(p, "dw_product_id")


@register("lookup_left_outer")
def q_lookup_left_outer(spark, sf):
    """Staged employees with their office id, NULL when the office is unknown."""
    st = A.stage(spark, sf, "employees").select("employeenumber", "officecode")
    return lookup(st, A.previous(spark, sf, "offices"), "officecode", "officecode",
                  "dw_office_id", "dw_office_id", required=False)


@register("lookup_required")
def q_lookup_required(spark, sf):
    """C4: staged orders with their customer id; orders of unknown customers dropped."""
    st = A.stage(spark, sf, "orders").select("ordernumber", "customernumber")
    return lookup(st, A.previous(spark, sf, "customers"), "customernumber",
                  "src_customernumber", "dw_customer_id", "dw_customer_id", required=True)


@register("anti_join_new_keys")
def q_anti_join_new_keys(spark, sf):
    """Staged customers not yet in the warehouse."""
    st = A.stage(spark, sf, "customers").select("customernumber", "customername")
    return new_keys(st, A.previous(spark, sf, "customers"), ["customernumber"],
                    ["src_customernumber"])


@register("anti_join_composite")
def q_anti_join_composite(spark, sf):
    """Staged order lines whose (order, product) is new."""
    st = A.stage(spark, sf, "orderdetails").select("ordernumber", "productcode", "quantityordered")
    return new_keys(st, A.previous(spark, sf, "orderdetails"), ["ordernumber", "productcode"],
                    ["src_ordernumber", "src_productcode"])


@register("anti_join_month")
def q_anti_join_month(spark, sf):
    """(month, customer) pairs of the batch absent from the monthly table."""
    from nightshift.operators.rollforward import MONTH, monthly_delta

    d = A.daily_table(spark, sf, "customer")
    delta = monthly_delta(d, "dw_customer_id", DAILY_CUSTOMER_MEASURES, A.BATCH) \
        .select(MONTH, "dw_customer_id")
    prev = A.previous_monthly(spark, sf, "customer", d)
    return new_keys(delta, prev, [MONTH, "dw_customer_id"], [MONTH, "dw_customer_id"])


@register("self_join_manager")
def q_self_join_manager(spark, sf):
    """Staged employees with their manager's id from the table itself."""
    st = A.stage(spark, sf, "employees").select("employeenumber", "reportsto")
    return lookup(st, A.previous(spark, sf, "employees"), "reportsto", "employeenumber",
                  "dw_employee_id", "dw_reporting_employee_id", required=False)


@register("semi_join_changed")
def q_semi_join_changed(spark, sf):
    """C11: history rows whose id changed (the UPDATE's target set)."""
    from nightshift.operators.scd2 import ids_to_close

    spec = SCD2_SPECS["customer_history"]
    hist = A.previous_history(spark, sf, "customer_history")
    ids = ids_to_close(hist, A.current(spark, sf, "customers"), spec)
    return hist.join(ids, "dw_customer_id", "left_semi").select(
        "dw_customer_id", "creditlimit", "effective_from_date")


@register("first_payment_join")
def q_first_payment_join(spark, sf):
    """Each payment with the customer's first payment day."""
    pay = A.current(spark, sf, "payments")
    first = daily.first_payment(pay)
    return pay.join(first, "dw_customer_id").select(
        "dw_customer_id", "checknumber", "paymentdate", "first_payment_date")


# --- D: aggregations ------------------------------------------------------------------

@register("agg_sum_product")
def q_agg_sum_product(spark, sf):
    """SUM(quantity * price) per order (exact decimal)."""
    d = A.current(spark, sf, "orderdetails")
    q = F.col("quantityordered")
    return d.groupBy("dw_order_id").agg(
        F.sum(q * F.col("priceeach")).cast("decimal(38,2)").alias("order_amount"),
        F.sum(q).alias("order_qty"),
    )


@register("agg_count_distinct")
def q_agg_count_distinct(spark, sf):
    """D3: two COUNT DISTINCTs in one group (orders and products per customer-day)."""
    lines = q_join_inner_orders_details(spark, sf)
    return lines.groupBy(F.col("orderdate").alias("summary_date"), "dw_customer_id").agg(
        F.count_distinct("dw_order_id").alias("order_count"),
        F.count_distinct("dw_product_id").alias("products_items_qty"),
    )


@register("agg_max_flag")
def q_agg_max_flag(spark, sf):
    """MAX of 0/1 flags as a boolean OR, per customer over the batch's days."""
    dc = daily.daily_customer_summary(A.fact_inputs(spark, sf), A.BATCH)
    return dc.groupBy("dw_customer_id").agg(
        F.max("order_apd").alias("order_apm"),
        F.max("payment_apd").alias("payment_apm"),
        F.max("new_customer_apd").alias("new_customer_apm"),
    )


@register("agg_conditional_max")
def q_agg_conditional_max(spark, sf):
    """MAX(CASE WHEN day = first day THEN 1 ELSE 0 END) per customer-day."""
    pay = A.current(spark, sf, "payments")
    # The flag depends on the day alone: days are made distinct before the join.
    days = pay.groupBy("paymentdate", "dw_customer_id").agg(F.count(F.lit(1)).alias("n"))
    j = days.join(daily.first_payment(pay), "dw_customer_id")
    return j.groupBy("paymentdate", "dw_customer_id").agg(
        F.max(F.when(day("paymentdate") == F.col("first_payment_date"), 1).otherwise(0))
        .alias("new_customer_paid_apd")
    )


@register("agg_group_by_month")
def q_agg_group_by_month(spark, sf):
    """GROUP BY an expression (month of the order date)."""
    o = A.current(spark, sf, "orders")
    return o.groupBy(month_start("orderdate").alias("start_of_the_month_date"),
                     "dw_customer_id").agg(F.count(F.lit(1)).alias("order_count"))


@register("group_by_distinct")
def q_group_by_distinct(spark, sf):
    """GROUP BY without aggregates = DISTINCT (customer creation days)."""
    c = A.current(spark, sf, "customers")
    return c.select(day("src_create_timestamp").alias("summary_date"), "dw_customer_id").distinct()


# --- F/G/H: order, union, scalars -------------------------------------------------------

@register("sorted_daily_output")
def q_sorted_daily_output(spark, sf):
    """the daily rows ordered by (date, customer) (a range-partitioned sort)."""
    dc = daily.daily_customer_summary(A.fact_inputs(spark, sf), A.BATCH)
    return dc.orderBy("summary_date", "dw_customer_id")


@register("union_all_branches")
def q_union_all_branches(spark, sf):
    """G1: the five zero-padded branches, UNION ALL by name (not re-aggregated)."""
    wh = A.fact_inputs(spark, sf)
    out = None
    for fn in daily.CUSTOMER_BRANCHES.values():
        part = fn(wh, A.BATCH)
        out = part if out is None else out.unionByName(part)
    return out


@register("scalar_month_start")
def q_scalar_month_start(spark, sf):
    """H2: DATE_TRUNC('month', d) as a date."""
    o = A.current(spark, sf, "orders")
    return o.select("dw_order_id", "orderdate",
                    month_start("orderdate").alias("start_of_the_month_date"))


@register("scalar_day_before")
def q_scalar_day_before(spark, sf):
    """H3: the day before each batch date (an SCD2 effective_to_date)."""
    bc = A.batch_control(spark, sf)
    return bc.select("etl_batch_no", "etl_batch_date",
                     day_before("etl_batch_date").alias("effective_to_date"))


@register("scalar_status_normalize")
def q_scalar_status_normalize(spark, sf):
    """H6: LOWER(TRIM(status))."""
    o = A.current(spark, sf, "orders")
    return o.select("dw_order_id", "status", normalized("status").alias("status_normalized"))


@register("scalar_sticky_flag")
def q_scalar_sticky_flag(spark, sf):
    """H7: CASE WHEN month flag = 1 THEN 1 ELSE day flag END on matched month rows."""
    from nightshift.operators.rollforward import MONTH, monthly_delta

    d = A.daily_table(spark, sf, "customer")
    delta = monthly_delta(d, "dw_customer_id", DAILY_CUSTOMER_MEASURES, A.BATCH) \
        .select(MONTH, "dw_customer_id", F.col("order_apd").alias("day_order_apd"))
    prev = A.previous_monthly(spark, sf, "customer", d).select(
        MONTH, "dw_customer_id", F.col("order_apm").alias("month_order_apm"))
    j = prev.join(delta, [MONTH, "dw_customer_id"])
    return j.select(MONTH, "dw_customer_id", "month_order_apm", "day_order_apd",
                    sticky_flag("month_order_apm", "day_order_apd").alias("order_apm"))


# --- full-history and first-load variants, remaining inventory rows ------------------

@register("daily_customer_summary_full")
def q_daily_customer_summary_full(spark, sf):
    """I11 over the whole history (cutoff at the epoch): the backfill case."""
    return daily.daily_customer_summary(A.fact_inputs(spark, sf), A.FULL_HISTORY)


@register("daily_product_summary_full")
def q_daily_product_summary_full(spark, sf):
    """I12 over the whole history."""
    return daily.daily_product_summary(A.fact_inputs(spark, sf), A.FULL_HISTORY)


@register("upsert_first_load_customers")
def q_upsert_first_load_customers(spark, sf):
    """I3 + I16 into an empty table: every source customer inserted, ids 1..n."""
    target = empty_table(spark, "customers")
    stage = extract.blanks_as_null(
        extract.extract_incremental(A.source(spark, sf, "customers"), "customers", A.EPOCH))
    return programs.upsert("customers", {"customers": target}, stage, A.BATCH)


@register("scd2_first_load_product")
def q_scd2_first_load_product(spark, sf):
    """I10 on an empty history: one active version per product."""
    hist = empty_table(spark, "product_history")
    wh = {"product_history": hist, "products": A.current(spark, sf, "products")}
    return programs.history("product_history", wh, A.BATCH)


@register("agg_min_date")
def q_agg_min_date(spark, sf):
    """MIN(date) per customer (the first-payment subquery)."""
    return daily.first_payment(A.current(spark, sf, "payments"))


@register("agg_max_lineage")
def q_agg_max_lineage(spark, sf):
    """MAX of the batch columns per month over the daily table."""
    from nightshift.operators.rollforward import MONTH

    d = A.daily_table(spark, sf, "customer")
    return d.groupBy(month_start("summary_date").alias(MONTH)).agg(
        F.max("etl_batch_no").alias("etl_batch_no"),
        F.max("etl_batch_date").alias("etl_batch_date"),
        F.max("dw_update_timestamp").alias("dw_update_timestamp"),
    )


@register("union_all_product_branches")
def q_union_all_product_branches(spark, sf):
    """The two product branches, UNION ALL by name."""
    wh = A.fact_inputs(spark, sf)
    return daily.product_ordered(wh, A.BATCH).unionByName(daily.product_cancelled(wh, A.BATCH))
