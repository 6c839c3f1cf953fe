"""The fourteen warehouse programs as pure functions.

``warehouse`` is a mapping from table name to the current DataFrame of that
warehouse table; ``stage`` maps source table name to its staged batch.
Every program returns the whole new table (nothing is written here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from nightshift.batch import Batch
from nightshift.functions import month_start
from nightshift.operators.rollforward import rollforward_merge, rollforward_parts
from nightshift.operators.scd1 import Scd1Result, Touched, scd1_merge_parts, scd1_touched
from nightshift.operators.scd2 import scd2_merge
from nightshift.plans import daily
from nightshift.plans.tables import DATED, LAYOUT, ORDER_MONTH
from nightshift.schemas import (
    DAILY_CUSTOMER_MEASURES,
    DAILY_PRODUCT_MEASURES,
    SCD1_SPECS,
    SCD2_SPECS,
    Lookup,
)


def upsert_parts(table: str, warehouse: dict[str, DataFrame], stage: DataFrame,
                 batch: Batch, resolve_within_batch: bool = False) -> Scd1Result:
    spec = SCD1_SPECS[table]
    parents = {lk.parent: warehouse[lk.parent] for lk in spec.lookups if not lk.self_ref}
    return scd1_merge_parts(warehouse[table], stage, spec, batch, parents,
                            resolve_within_batch=resolve_within_batch)


def upsert(table: str, warehouse, stage, batch, resolve_within_batch: bool = False) -> DataFrame:
    """``upsert_<table>``."""
    return upsert_parts(table, warehouse, stage, batch, resolve_within_batch).table


#: Where an order line is stored: the month of its order.
LINE_MONTH = Lookup("orders", "ordernumber", "src_ordernumber", ORDER_MONTH, ORDER_MONTH, True)
#: Columns whose changes a later program reads: (id, column).
TRACKED = {
    **{spec.dim: (spec.id_col, spec.tracked) for spec in SCD2_SPECS.values()},
    "payments": ("dw_customer_id", "paymentdate"),
}


def upsert_touched(table: str, warehouse: dict[str, DataFrame], stage: DataFrame, batch: Batch, width: int,
                   resolve_within_batch: bool = False) -> Touched:
    """I1-I8 on stored tables: the partitions that the batch touches."""
    spec = SCD1_SPECS[table]
    parents = {lk.parent: warehouse[lk.parent] for lk in spec.lookups if not lk.self_ref}
    where = {"part": LAYOUT[table][0], "width": width}
    if table == "orderdetails":
        where["part_from"] = LINE_MONTH
    elif table in DATED:
        where["part_of"] = month_start(DATED[table][1])
    return scd1_touched(warehouse[table], stage, spec, batch, parents=parents, tracked=TRACKED.get(table),
                        resolve_within_batch=resolve_within_batch, **where)


def history(name: str, warehouse, batch: Batch) -> DataFrame:
    """``scd2_customer_history`` / ``scd2_product_history``."""
    spec = SCD2_SPECS[name]
    return scd2_merge(warehouse[name], warehouse[spec.dim], spec, batch)


def daily_customer(warehouse, batch: Batch) -> DataFrame:
    """I11 (new rows only; the program has no update half)."""
    return daily.daily_customer_summary(warehouse, batch)


def daily_product(warehouse, batch: Batch) -> DataFrame:
    """I12."""
    return daily.daily_product_summary(warehouse, batch)


MONTHLY = {
    "monthly_customer_summary": ("daily_customer_summary", "dw_customer_id", DAILY_CUSTOMER_MEASURES),
    "monthly_product_summary": ("daily_product_summary", "dw_product_id", DAILY_PRODUCT_MEASURES),
}


def monthly(name: str, warehouse, batch: Batch) -> DataFrame:
    """Roll the daily rows of the batch into the monthly table."""
    src, key, measures = MONTHLY[name]
    return rollforward_merge(warehouse[name], warehouse[src], key, measures, batch)


def monthly_parts(name: str, warehouse, batch: Batch):
    src, key, measures = MONTHLY[name]
    return rollforward_parts(warehouse[name], warehouse[src], key, measures, batch)


def merge_counts_of(table: str, warehouse, stage, batch: Batch) -> DataFrame:
    """The (updated, inserted) row counts the merge driver reports."""
    from nightshift.operators.scd1 import merge_counts

    return merge_counts(upsert_parts(table, warehouse, stage, batch), table)
