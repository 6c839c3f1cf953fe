"""Daily customer and product summaries.

Two shapes are provided for each summary:

* the *branch* functions mirror the programs' structure: one aggregate per
  branch, zero padded, ``unionByName`` and a second aggregation (D10, G1).
  They are the per-branch queries and the reference for tests.
* ``daily_customer_summary`` / ``daily_product_summary`` join orders with
  their details **once**: each detail line gives a row for each event it takes
  part in (ordered / cancelled / shipped, plus one row per distinct ordered
  product), an aggregation at event grain
  replaces the COUNT DISTINCTs, and one final shuffle on (date, id) merges
  all branches with map-side partial aggregation.

Inputs are warehouse tables (``customers orders orderdetails products
payments``); every cutoff is ``day >= batch.date`` and reaches the scan as a
pushed filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.functions import day, flag, normalized, on_or_after, status_is
from nightshift.operators.joins import bounded_broadcast, dealt, fits, join_small_side, with_keys_of
from nightshift.schemas import (
    DAILY_CUSTOMER_MEASURES,
    DAILY_PRODUCT_MEASURES,
    STATUS_CANCELLED,
    STATUS_SHIPPED,
    measure_type,
)
from nightshift.session import materialize

CUSTOMER_KEY = "dw_customer_id"
PRODUCT_KEY = "dw_product_id"
ORDER_MONTH = "order_month"
#: Lines of an order, about; it only sets the number of tasks.
LINES_AN_ORDER = 4
#: What an order line takes part in (``kind``).
ORDERED, ORDERED_PRODUCT, CANCELLED, SHIPPED = range(4)


def _zero(name: str) -> Column:
    return F.lit(0).cast(measure_type(name))


def _row(date: Column, key: Column, key_name: str, measures, values: dict[str, Column],
         default=_zero) -> list[Column]:
    """A branch row: the given measures, the others padded (0 by default)."""
    out = [date.alias("summary_date"), key.alias(key_name)]
    for name, _ in measures:
        v = values.get(name)
        out.append((v.cast(measure_type(name)) if v is not None else default(name)).alias(name))
    return out


def _finish(rows: DataFrame, key_name: str, measures, batch: Batch) -> DataFrame:
    """The second-level aggregation (sum / max per measure) + batch columns."""
    aggs = []
    for name, kind in measures:
        agg = F.sum(name) if kind == "sum" else F.max(name)
        aggs.append(agg.cast(measure_type(name)).alias(name))
    out = rows.groupBy("summary_date", key_name).agg(*aggs)
    return out.select(
        "summary_date",
        key_name,
        *[name for name, _ in measures],
        batch.ts_col.alias("dw_create_timestamp"),
        batch.ts_col.alias("dw_update_timestamp"),
        batch.no_col.alias("etl_batch_no"),
        batch.date_col.alias("etl_batch_date"),
    )


# --- customer summary: branches (reference shape) ---------------------------

def _lines(wh: dict[str, DataFrame]) -> DataFrame:
    details = wh["orderdetails"].drop(
        "src_create_timestamp", "src_update_timestamp", "dw_create_timestamp",
        "dw_update_timestamp", "etl_batch_no", "etl_batch_date", "src_ordernumber",
        CUSTOMER_KEY)
    return wh["orders"].join(with_keys_of(details, wh["orders"], "dw_order_id"), "dw_order_id")


def _cm(values: dict[str, Column], date: Column, key: Column) -> list[Column]:
    return _row(date, key, CUSTOMER_KEY, DAILY_CUSTOMER_MEASURES, values)


def customer_new(wh, batch: Batch) -> DataFrame:
    """Branch 1: customers created on or after the batch date."""
    c = wh["customers"].where(on_or_after("src_create_timestamp", batch.date))
    d = day("src_create_timestamp")
    return (
        c.select(d.alias("summary_date"), CUSTOMER_KEY).distinct()
        .select(*_cm({"new_customer_apd": F.lit(1)}, F.col("summary_date"), F.col(CUSTOMER_KEY)))
    )


def customer_ordered(wh, batch: Batch) -> DataFrame:
    """Branch 2: orders x details x products by order day."""
    o = wh["orders"].where(on_or_after("orderdate", batch.date))
    lines = _lines({"orders": o, "orderdetails": wh["orderdetails"]})
    lines = lines.join(wh["products"].select(PRODUCT_KEY, "msrp"), PRODUCT_KEY)
    q, p = F.col("quantityordered"), F.col("priceeach")
    g = lines.groupBy(day("orderdate").alias("summary_date"), CUSTOMER_KEY).agg(
        F.count_distinct("dw_order_id").alias("order_count"),
        F.sum(q * p).alias("order_cost_amount"),
        F.sum(q).alias("products_ordered_qty"),
        F.count_distinct(PRODUCT_KEY).alias("products_items_qty"),
        F.sum(q * F.col("msrp")).alias("order_mrp_amount"),
    )
    return g.select(*_cm(
        {
            "order_count": F.col("order_count"),
            "order_apd": F.lit(1),
            "order_cost_amount": F.col("order_cost_amount"),
            "products_ordered_qty": F.col("products_ordered_qty"),
            "products_items_qty": F.col("products_items_qty"),
            "order_mrp_amount": F.col("order_mrp_amount"),
        },
        F.col("summary_date"), F.col(CUSTOMER_KEY),
    ))


def _status_branch(wh, batch: Batch, date_col: str, status: str, prefix: str) -> DataFrame:
    o = wh["orders"].where(
        on_or_after(date_col, batch.date)
        & F.col(date_col).isNotNull()
        & status_is("status", status)
    )
    lines = _lines({"orders": o, "orderdetails": wh["orderdetails"]})
    g = lines.groupBy(day(date_col).alias("summary_date"), CUSTOMER_KEY).agg(
        F.count_distinct("dw_order_id").alias("n"),
        F.sum(F.col("quantityordered") * F.col("priceeach")).alias("amount"),
    )
    return g.select(*_cm(
        {
            f"{prefix}_order_count": F.col("n"),
            f"{prefix}_order_amount": F.col("amount"),
            f"{prefix}_order_apd": F.lit(1),
        },
        F.col("summary_date"), F.col(CUSTOMER_KEY),
    ))


def customer_cancelled(wh, batch: Batch) -> DataFrame:
    """Branch 3: cancelled orders (date set *and* status 'cancelled')."""
    return _status_branch(wh, batch, "cancelleddate", STATUS_CANCELLED, "cancelled")


def customer_shipped(wh, batch: Batch) -> DataFrame:
    """Branch 4: shipped orders (date set and status 'shipped')."""
    return _status_branch(wh, batch, "shippeddate", STATUS_SHIPPED, "shipped")


def first_payment(payments: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """First payment day per customer over *all* payments.

    When ``customers`` (the ones that matter) is given and small, it filters
    the payments map-side before the aggregation.
    """
    p = payments.where(F.col("paymentdate").isNotNull())
    if customers is not None:
        p = p.join(bounded_broadcast(customers), CUSTOMER_KEY, "left_semi")
    return p.groupBy(CUSTOMER_KEY).agg(F.min(day("paymentdate")).alias("first_payment_date"))


def paid_days(pay: DataFrame, first: DataFrame) -> DataFrame:
    """``(summary_date, customer, amount, first)``, one row per customer and day.

    Payments are summed per day first and the first day joined after: whether
    a day is the first depends on the day alone.  So a customer with many
    payments is reduced map-side and reaches the join with a row per day.
    """
    days = pay.groupBy(day("paymentdate").alias("summary_date"), CUSTOMER_KEY).agg(F.sum("amount").alias("amount"))
    return days.join(first, CUSTOMER_KEY).select(
        "summary_date", CUSTOMER_KEY, "amount",
        flag(F.col("summary_date") == F.col("first_payment_date")).alias("first"),
    )


def customer_paid(wh, batch: Batch) -> DataFrame:
    """Branch 5: payments by day, with the first-payment flag."""
    pay = wh["payments"].where(
        on_or_after("paymentdate", batch.date) & F.col("paymentdate").isNotNull()
    )
    g = paid_days(pay, first_payment(wh["payments"], pay.select(CUSTOMER_KEY).distinct()))
    return g.select(*_cm(
        {
            "payment_apd": F.lit(1),
            "payment_amount": F.col("amount"),
            "new_customer_paid_apd": F.col("first"),
        },
        F.col("summary_date"), F.col(CUSTOMER_KEY),
    ))


def first_payments_touched(
    known: DataFrame, payments: DataFrame, merged: DataFrame, changes: DataFrame, width: int
) -> tuple[DataFrame, list]:
    """C13 kept up by the batch: rows of the id ranges that its payments touch, and the ranges that may lose rows.

    ``known`` has (customer, first day) so far, ``merged`` the batch's payments
    as stored now, ``changes`` their (customer, old, new) days.  A payment can
    only bring a customer's first day forward, unless one that had it moves
    to a later day or loses its day: then, and only for such customers, the
    day is looked up in all payments again.
    """
    touch = bounded_broadcast(materialize(
        merged.where(F.col("paymentdate").isNotNull()).groupBy(CUSTOMER_KEY).agg(F.min(day("paymentdate")).alias("__day"))))
    back = changes.where(F.col("old").isNotNull() & (F.col("new").isNull() | (day("new") > day("old"))))
    moved = materialize(back.select(CUSTOMER_KEY).distinct())
    id_range = F.floor(F.col(CUSTOMER_KEY) / F.lit(width)).cast("bigint")
    ranges = [r[0] for r in touch.select(CUSTOMER_KEY).unionByName(moved).select(id_range.alias("r")).distinct().collect()]
    held = known.where(F.col("id_range").isin(ranges)).select(CUSTOMER_KEY, "first_payment_date")
    days = held.unionByName(touch.select(CUSTOMER_KEY, F.col("__day").alias("first_payment_date")))
    first = days.groupBy(CUSTOMER_KEY).agg(F.min("first_payment_date").alias("first_payment_date"))
    if moved.isEmpty():
        return first.withColumn("id_range", id_range), []
    first = first.join(bounded_broadcast(moved), CUSTOMER_KEY, "left_anti").unionByName(first_payment(payments, moved))
    return first.withColumn("id_range", id_range), ranges


CUSTOMER_BRANCHES = {
    "new": customer_new,
    "ordered": customer_ordered,
    "cancelled": customer_cancelled,
    "shipped": customer_shipped,
    "paid": customer_paid,
}


def daily_customer_summary_by_branches(wh, batch: Batch) -> DataFrame:
    """I11 in the programs' own shape: 5 branches, UNION ALL, re-aggregate."""
    rows = None
    for fn in CUSTOMER_BRANCHES.values():
        part = fn(wh, batch)
        rows = part if rows is None else rows.unionByName(part)
    return _finish(rows, CUSTOMER_KEY, DAILY_CUSTOMER_MEASURES, batch)


# --- customer summary: one pass over the order lines -------------------------

def _stored_by(wh) -> list[str]:
    """The month by which stored orders and their lines are laid out, where both have it."""
    both = set(wh["orders"].columns) & set(wh["orderdetails"].columns)
    return [ORDER_MONTH] if ORDER_MONTH in both else []


def _lines_of(orders: DataFrame, wh) -> DataFrame:
    """The order lines of ``orders``; only the months of those orders are read of the stored lines."""
    stored = _stored_by(wh)
    details = wh["orderdetails"].select("dw_order_id", PRODUCT_KEY, "quantityordered", "priceeach", *stored)
    return join_small_side(details, orders, "dw_order_id", stored_by=stored[0] if stored else None)


def _with_products(lines: DataFrame, products: DataFrame, orders: DataFrame, how: str) -> DataFrame:
    """The lines of ``orders`` with the columns of ``products``, which are broadcast if they are few."""
    if fits(products):
        return lines.join(F.broadcast(products), PRODUCT_KEY, how)
    return dealt(lines, LINES_AN_ORDER * orders.count(), PRODUCT_KEY).join(products, PRODUCT_KEY, how)


def _events(lines: DataFrame, when: dict[int, Column]) -> DataFrame:
    """A row for each ``kind`` whose condition the line meets."""
    kinds = F.array(*[F.when(met, F.lit(kind)) for kind, met in when.items()])
    return lines.withColumn("kind", F.explode(kinds)).where(F.col("kind").isNotNull())


def _order_events(wh, batch: Batch) -> DataFrame:
    """Order lines with an event on or after the cutoff, joined once."""
    D = batch.date
    orders = wh["orders"].where(
        on_or_after("orderdate", D) | on_or_after("cancelleddate", D) | on_or_after("shippeddate", D)
    ).select(
        "dw_order_id",
        CUSTOMER_KEY,
        *_stored_by(wh),
        day("orderdate").alias("od"),
        day("cancelleddate").alias("cd"),
        day("shippeddate").alias("sd"),
        normalized("status").alias("st"),
    )
    products = wh["products"].select(PRODUCT_KEY, "msrp", F.lit(True).alias("has_product"))
    lines = _lines_of(orders, wh)
    return _with_products(lines, products, orders, "left")


def daily_customer_summary(wh, batch: Batch) -> DataFrame:
    """I11, one join of orders with details for the three order branches."""
    D = F.lit(batch.date)
    lines = _order_events(wh, batch)
    q, p, msrp = F.col("quantityordered"), F.col("priceeach"), F.col("msrp")
    matched = F.col("has_product").isNotNull()
    amount = q * p

    ordered = matched & (F.col("od") >= D)
    k = F.col("kind")
    exploded = _events(lines, {
        ORDERED: ordered,
        ORDERED_PRODUCT: ordered,
        CANCELLED: F.col("cd").isNotNull() & (F.col("cd") >= D) & (F.col("st") == STATUS_CANCELLED),
        SHIPPED: F.col("sd").isNotNull() & (F.col("sd") >= D) & (F.col("st") == STATUS_SHIPPED),
    }).select(
        CUSTOMER_KEY,
        "kind",
        F.when(k == CANCELLED, F.col("cd")).when(k == SHIPPED, F.col("sd")).otherwise(F.col("od")).alias("summary_date"),
        F.when(k == ORDERED_PRODUCT, F.col(PRODUCT_KEY)).otherwise(F.col("dw_order_id")).alias("grain"),
        F.when(k != ORDERED_PRODUCT, amount).cast("decimal(23,2)").alias("cost"),
        F.when(k == ORDERED, q).cast("bigint").alias("qty"),
        F.when(k == ORDERED, q * msrp).cast("decimal(23,2)").alias("mrp"),
    )
    # Event grain: one row per (day, customer, kind, order) or per distinct
    # ordered product; this is what the COUNT DISTINCTs count.
    grain = exploded.groupBy("summary_date", CUSTOMER_KEY, "kind", "grain").agg(
        F.sum("cost").alias("cost"), F.sum("qty").alias("qty"), F.sum("mrp").alias("mrp")
    )

    def only(kind: int, value: Column, other: Column) -> Column:
        return F.when(k == kind, value).otherwise(other)

    # Measures of the ordered branch stay NULL on its product rows (and vice
    # versa) so that NULL sums behave as in the branch form; other branches
    # pad with 0.
    ordered_family = k.isin(ORDERED, ORDERED_PRODUCT)

    def zero_or_null() -> Column:
        return F.when(ordered_family, F.lit(None)).otherwise(F.lit(0))

    order_rows = grain.select(*_cm(
        {
            "order_count": only(ORDERED, F.lit(1), zero_or_null()),
            "order_apd": only(ORDERED, F.lit(1), zero_or_null()),
            "order_cost_amount": only(ORDERED, F.col("cost"), zero_or_null()),
            "products_ordered_qty": only(ORDERED, F.col("qty"), zero_or_null()),
            "order_mrp_amount": only(ORDERED, F.col("mrp"), zero_or_null()),
            "products_items_qty": only(ORDERED_PRODUCT, F.lit(1), zero_or_null()),
            "cancelled_order_count": only(CANCELLED, F.lit(1), F.lit(0)),
            "cancelled_order_amount": only(CANCELLED, F.col("cost"), F.lit(0)),
            "cancelled_order_apd": only(CANCELLED, F.lit(1), F.lit(0)),
            "shipped_order_count": only(SHIPPED, F.lit(1), F.lit(0)),
            "shipped_order_amount": only(SHIPPED, F.col("cost"), F.lit(0)),
            "shipped_order_apd": only(SHIPPED, F.lit(1), F.lit(0)),
        },
        F.col("summary_date"), F.col(CUSTOMER_KEY),
    ))
    # New customers and payments go straight to the final aggregation.
    c = wh["customers"].where(on_or_after("src_create_timestamp", batch.date))
    new_rows = c.select(*_cm({"new_customer_apd": F.lit(1)}, day("src_create_timestamp"),
                             F.col(CUSTOMER_KEY)))
    pay = wh["payments"].where(
        on_or_after("paymentdate", batch.date) & F.col("paymentdate").isNotNull()
    )
    # Kept by the batches where the warehouse is stored; else made from all payments.
    first = wh.get("first_payments")
    if first is None:
        first = first_payment(wh["payments"], pay.select(CUSTOMER_KEY).distinct())
    paid = paid_days(pay, first.select(CUSTOMER_KEY, "first_payment_date"))
    pay_rows = paid.select(*_cm(
        {
            "payment_apd": F.lit(1),
            "payment_amount": F.col("amount"),
            "new_customer_paid_apd": F.col("first"),
        },
        F.col("summary_date"), F.col(CUSTOMER_KEY),
    ))
    rows = order_rows.unionByName(new_rows).unionByName(pay_rows)
    return _finish(rows, CUSTOMER_KEY, DAILY_CUSTOMER_MEASURES, batch)


# --- product summary ------------------------------------------------------------

def _pm(values: dict[str, Column], date: Column, key: Column) -> list[Column]:
    return _row(date, key, PRODUCT_KEY, DAILY_PRODUCT_MEASURES, values)


def _product_lines(wh, cond: Column) -> DataFrame:
    o = wh["orders"].where(cond)
    lines = _lines({"orders": o, "orderdetails": wh["orderdetails"]})
    return lines.join(wh["products"].select(PRODUCT_KEY, "msrp"), PRODUCT_KEY)


def product_ordered(wh, batch: Batch) -> DataFrame:
    lines = _product_lines(wh, on_or_after("orderdate", batch.date))
    q = F.col("quantityordered")
    g = lines.groupBy(day("orderdate").alias("summary_date"), PRODUCT_KEY).agg(
        F.sum(q * F.col("priceeach")).alias("cost"), F.sum(q * F.col("msrp")).alias("mrp")
    )
    return g.select(*_pm(
        {"customer_apd": F.lit(1), "product_cost_amount": F.col("cost"),
         "product_mrp_amount": F.col("mrp")},
        F.col("summary_date"), F.col(PRODUCT_KEY),
    ))


def product_cancelled(wh, batch: Batch) -> DataFrame:
    """Cancelled products: only the date counts, not the status (trap 7)."""
    lines = _product_lines(
        wh, F.col("cancelleddate").isNotNull() & on_or_after("cancelleddate", batch.date)
    )
    q = F.col("quantityordered")
    g = lines.groupBy(day("cancelleddate").alias("summary_date"), PRODUCT_KEY).agg(
        F.sum(q).alias("qty"),
        F.sum(q * F.col("priceeach")).alias("cost"),
        F.sum(q * F.col("msrp")).alias("mrp"),
    )
    return g.select(*_pm(
        {"customer_apd": F.lit(1), "cancelled_product_qty": F.col("qty"),
         "cancelled_cost_amount": F.col("cost"), "cancelled_mrp_amount": F.col("mrp"),
         "cancelled_order_apd": F.lit(1)},
        F.col("summary_date"), F.col(PRODUCT_KEY),
    ))


PRODUCT_BRANCHES = {"ordered": product_ordered, "cancelled": product_cancelled}


def daily_product_summary_by_branches(wh, batch: Batch) -> DataFrame:
    rows = product_ordered(wh, batch).unionByName(product_cancelled(wh, batch))
    return _finish(rows, PRODUCT_KEY, DAILY_PRODUCT_MEASURES, batch)


def daily_product_summary(wh, batch: Batch) -> DataFrame:
    """I12 with one join: each line emits its ordered and cancelled event."""
    D = batch.date
    orders = wh["orders"].where(
        on_or_after("orderdate", D) | on_or_after("cancelleddate", D)
    ).select("dw_order_id", *_stored_by(wh), day("orderdate").alias("od"), day("cancelleddate").alias("cd"))
    products = wh["products"].select(PRODUCT_KEY, "msrp")
    lines = _with_products(_lines_of(orders, wh), products, orders, "inner")
    q = F.col("quantityordered")
    cost, mrp = q * F.col("priceeach"), q * F.col("msrp")
    rows = _events(lines, {
        ORDERED: F.col("od") >= F.lit(D),
        CANCELLED: F.col("cd").isNotNull() & (F.col("cd") >= F.lit(D)),
    })
    ordered = F.col("kind") == ORDERED

    def only(of: Column, value: Column) -> Column:
        return F.when(of, value).otherwise(F.lit(0))

    padded = rows.select(*_pm(
        {
            "customer_apd": F.lit(1),
            "product_cost_amount": only(ordered, cost),
            "product_mrp_amount": only(ordered, mrp),
            "cancelled_product_qty": only(~ordered, q),
            "cancelled_cost_amount": only(~ordered, cost),
            "cancelled_mrp_amount": only(~ordered, mrp),
            "cancelled_order_apd": only(~ordered, F.lit(1)),
        },
        F.when(ordered, F.col("od")).otherwise(F.col("cd")), F.col(PRODUCT_KEY),
    ))
    return _finish(padded, PRODUCT_KEY, DAILY_PRODUCT_MEASURES, batch)
