"""Type-2 history of one tracked attribute.

Run on the already merged dimension.  Close: every active row whose id's
tracked value changed (NULL-safe) gets ``dw_active_record_ind = 0``,
``effective_to_date = batch date - 1`` and the batch's update stamps.  Open:
every dimension row without an active row *after* the close gets a new
active row from the batch date on.  No deletes: a vanished id stays active.

Scale: nightly the changes come from the dimension's merge (old and new
value of the rows that it wrote), so only the versions of those ids are
looked at (``history_touched``): the id ranges that hold them are read and
written, closed versions go to a partition of their batch, and nothing is
compared for the rest.  Without such a feed (a first load, a batch that runs
again, the queries) one shuffle join compares the dimension with the active
rows on the id, two columns each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.functions import changed, day_before
from nightshift.operators.joins import bounded_broadcast
from nightshift.schemas import HISTORY_COLUMNS, Scd2Spec
from nightshift.session import materialize


def _compare(history: DataFrame, dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    active = history.where(F.col("dw_active_record_ind") == 1).select(
        spec.id_col, F.col(spec.tracked).alias("__old"), F.lit(True).alias("__active")
    )
    return dim.select(spec.id_col, spec.tracked).join(active, spec.id_col, "left")


def change_set(history: DataFrame, dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Dimension rows needing a new version: (id, value, __close).

    ``__close`` marks ids whose active row differs (C10 + B7); the others
    have no active row (C7).  One comparison, materialized once: both the
    close and the open half read it.
    """
    cmp = _compare(history, dim, spec)
    need = cmp.where(F.col("__active").isNull() | changed(spec.tracked, "__old"))
    return materialize(need.select(
        spec.id_col, spec.tracked, F.col("__active").isNotNull().alias("__close")
    ))


def ids_to_close(history: DataFrame, dim: DataFrame, spec: Scd2Spec,
                 changes: DataFrame | None = None) -> DataFrame:
    """C10 + B7: ids whose active row differs from the dimension."""
    ch = change_set(history, dim, spec) if changes is None else changes
    return ch.where("__close").select(spec.id_col).distinct()


def closed_version(batch: Batch) -> dict[str, Column]:
    """The columns that change when the batch closes a version."""
    return {
        "dw_active_record_ind": F.lit(0),
        "update_etl_batch_no": batch.no_col,
        "effective_to_date": day_before(batch.date_col),
        "update_etl_batch_date": batch.date_col,
        "dw_update_timestamp": batch.ts_col,
    }


def opened_version(batch: Batch) -> dict[str, Column]:
    """The columns of a version that the batch opens."""
    return {
        "effective_from_date": batch.date_col,
        "effective_to_date": F.lit(None).cast("date"),
        "dw_active_record_ind": F.lit(1),
        "dw_create_timestamp": batch.ts_col,
        "dw_update_timestamp": batch.ts_col,
        "create_etl_batch_no": batch.no_col,
        "create_etl_batch_date": batch.date_col,
        "update_etl_batch_no": F.lit(None).cast("int"),
        "update_etl_batch_date": F.lit(None).cast("date"),
    }


def rows_to_open(history: DataFrame, dim: DataFrame, spec: Scd2Spec, batch: Batch,
                 changes: DataFrame | None = None) -> DataFrame:
    """Dimension rows without an active version once changes are closed."""
    ch = change_set(history, dim, spec) if changes is None else changes
    need = ch.dropDuplicates([spec.id_col])
    return need.select(spec.id_col, spec.tracked, *[c.alias(n) for n, c in opened_version(batch).items()])


def close_changed(history: DataFrame, dim: DataFrame, spec: Scd2Spec, batch: Batch,
                  changes: DataFrame | None = None) -> DataFrame:
    """The history with changed active rows closed (the update half)."""
    closing_ids = bounded_broadcast(
        ids_to_close(history, dim, spec, changes).withColumn("__close", F.lit(True))
    )
    h = history.join(closing_ids, spec.id_col, "left")
    close = F.col("__close").isNotNull() & (F.col("dw_active_record_ind") == 1)
    new = closed_version(batch)
    cols = [spec.id_col, spec.tracked, *HISTORY_COLUMNS]
    return h.select(*[
        (F.when(close, new[c]).otherwise(F.col(c)) if c in new else F.col(c)).alias(c)
        for c in cols
    ])


def scd2_merge(history: DataFrame, dim: DataFrame, spec: Scd2Spec, batch: Batch) -> DataFrame:
    """The whole new history: closed + untouched rows, then opened rows."""
    changes = change_set(history, dim, spec)
    return close_changed(history, dim, spec, batch, changes).unionByName(
        rows_to_open(history, dim, spec, batch, changes)
    )


def history_touched(active: DataFrame, feed: DataFrame, spec: Scd2Spec, batch: Batch, width: int) -> DataFrame:
    """The history's partitions that the ids of ``feed`` touch, as they will be.

    ``feed`` has (id, value) of the dimension rows to look at, ``active`` the
    active versions of all id ranges that hold them.  Active versions lie in
    the partition of their id range, those that this batch closes in one of
    its own (``part`` is the batch number there).
    """
    held = bounded_broadcast(materialize(feed.select(spec.id_col, F.col(spec.tracked).alias("__new"), F.lit(True).alias("__in"))))
    h = active.join(held, spec.id_col, "left")
    close = F.col("__in").isNotNull() & changed(spec.tracked, "__new")
    columns = [spec.id_col, spec.tracked, *HISTORY_COLUMNS]
    shut = closed_version(batch)
    id_range = F.floor(F.col(spec.id_col) / F.lit(width)).cast("bigint").alias("part")
    closed = h.where(close).select(*[shut.get(c, F.col(c)).alias(c) for c in columns], batch.no_col.cast("bigint").alias("part"))
    stay = h.where(~close).select(*columns, id_range)
    current = h.where(F.col("__in").isNotNull() & ~close).select(F.col(spec.id_col).alias("__id"))
    need = held.join(current, F.col(spec.id_col) == F.col("__id"), "left_anti")
    opened = need.select(spec.id_col, F.col("__new").alias(spec.tracked)).select(
        spec.id_col, spec.tracked, *[c.alias(n) for n, c in opened_version(batch).items()], id_range)
    return closed.unionByName(stay).unionByName(opened)
