"""The stored warehouse tables: names, schemas and partition columns, as data.

Type-1 tables with ids are laid out by ranges of their surrogate id, so an
update rewrites the ranges of the rows it meets and an insert the last one.
Orders and payments are laid out by the month of their date when they were
inserted; order lines by the month of their order.  That month is where the
row is stored and never changes, also when the date does, so a row stays in
its partition and a line's month always equals its order's.  Histories keep
active versions by id range and closed ones by the batch that closed them,
which is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from nightshift.operators.rollforward import MONTH, monthly_columns
from nightshift.schemas import (
    DAILY_CUSTOMER_MEASURES, DAILY_PRODUCT_MEASURES, HISTORY_COLUMNS, SCD1_ORDER, SCD1_SPECS, SCD2_SPECS,
    SOURCE_SCHEMAS, measure_type,
)

LOG = "batch_control_log"
#: Ids in a range partition.
ID_WIDTH = 1_000_000
ID_RANGE = "id_range"
ORDER_MONTH = "order_month"
PAYMENT_MONTH = "payment_month"
FIRST_PAYMENTS = "first_payments"

#: The date that gives a row its month of storage when it is inserted.
DATED = {"orders": (ORDER_MONTH, "orderdate"), "payments": (PAYMENT_MONTH, "paymentdate")}

LAYOUT: dict[str, tuple[str, ...]] = {
    **{t: (ID_RANGE,) for t in ("offices", "employees", "customers", "productlines", "products", FIRST_PAYMENTS)},
    "orders": (ORDER_MONTH,),
    "orderdetails": (ORDER_MONTH,),
    "payments": (PAYMENT_MONTH,),
    **{t: ("dw_active_record_ind", "part") for t in SCD2_SPECS},
    **{f"daily_{k}_summary": ("etl_batch_no", "summary_month") for k in ("customer", "product")},
    **{f"monthly_{k}_summary": (MONTH,) for k in ("customer", "product")},
}
TABLES = (*SCD1_ORDER, *SCD2_SPECS, FIRST_PAYMENTS, *(t for t in LAYOUT if t.endswith("_summary")))

LONG, INT, DATE, STAMP = T.LongType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()
_TYPES = {
    "dw_create_timestamp": STAMP, "dw_update_timestamp": STAMP, "src_create_timestamp": STAMP, "src_update_timestamp": STAMP,
    "etl_batch_no": INT, "etl_batch_date": DATE, "create_etl_batch_no": INT, "create_etl_batch_date": DATE,
    "update_etl_batch_no": INT, "update_etl_batch_date": DATE, "effective_from_date": DATE, "effective_to_date": DATE,
    "dw_active_record_ind": INT, "summary_date": DATE, "summary_month": DATE, MONTH: DATE, "first_payment_date": DATE,
    ORDER_MONTH: DATE, PAYMENT_MONTH: DATE, ID_RANGE: LONG, "part": LONG,
}


def _columns(table: str) -> tuple[list[str], dict[str, T.DataType]]:
    """Column order, and the types that depend on the table."""
    if table in SCD1_SPECS:
        spec = SCD1_SPECS[table]
        staged = {f.name: f.dataType for f in SOURCE_SCHEMAS[table].fields}
        return list(spec.columns), {t: staged[s] for s, t in spec.keys + spec.attrs}
    if table in SCD2_SPECS:
        spec = SCD2_SPECS[table]
        staged = {f.name: f.dataType for f in SOURCE_SCHEMAS[spec.dim].fields}
        return [spec.id_col, spec.tracked, *HISTORY_COLUMNS], {spec.tracked: staged[spec.tracked]}
    if table == FIRST_PAYMENTS:
        return ["dw_customer_id", "first_payment_date"], {}
    key, measures = ("dw_customer_id", DAILY_CUSTOMER_MEASURES) if "customer" in table else ("dw_product_id", DAILY_PRODUCT_MEASURES)
    if table.startswith("monthly_"):
        names = monthly_columns(key, measures)
    else:
        names = ["summary_date", key, *[n for n, _ in measures], "dw_create_timestamp", "dw_update_timestamp", "etl_batch_no", "etl_batch_date"]
    return names, {n: measure_type(n) for n in names if n not in _TYPES and n != key}


def table_schema(table: str) -> T.StructType:
    """The stored schema: the table's columns, partition columns last."""
    names, types = _columns(table)
    parts = LAYOUT[table]
    return T.StructType([T.StructField(n, types.get(n) or _TYPES.get(n, LONG), True) for n in [*[n for n in names if n not in parts], *parts]])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """``table`` before its first load: its own columns, without those that only lay it out on disk."""
    schema = table_schema(table)
    return spark.createDataFrame([], T.StructType([schema[n] for n in _columns(table)[0]]))
