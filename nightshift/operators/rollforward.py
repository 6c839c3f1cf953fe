"""Monthly roll-forward of daily facts.

Daily rows dated on or after the batch date are grouped by (month start,
id).  Month rows that exist are updated: measures are added (NULL stays
NULL), ``_apd`` / ``_apm`` flags are sticky (1 stays 1, else the new
value), update stamp and batch columns move.  Month rows that do not exist
are inserted, with ``_apm`` = max of the daily ``_apd``.

Deliberate difference (SURVEY §7.4, trap 11): when several daily rows fall
into one existing month row, the reference adds one arbitrary match; here
the daily rows are summed first, so every one of them is added.

Scale: the monthly delta is pre-aggregated with map-side partial
aggregation, then broadcast (bounded count) into a single pass over the
monthly table; beyond the bound it is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.batch import Batch
from nightshift.functions import month_start, sticky_flag
from nightshift.operators.joins import fits
from nightshift.schemas import measure_type
from nightshift.session import materialize

MONTH = "start_of_the_month_date"


def monthly_columns(key: str, measures) -> list[str]:
    cols = [MONTH, key]
    for name, kind in measures:
        cols.append(name)
        if kind == "flag":
            cols.append(name[: -len("_apd")] + "_apm")
    return cols + ["dw_create_timestamp", "dw_update_timestamp", "etl_batch_no", "etl_batch_date"]


def monthly_delta(daily: DataFrame, key: str, measures, batch: Batch | None) -> DataFrame:
    """Daily rows >= batch date (all rows if no batch), summed per (month, id)."""
    d = daily if batch is None else daily.where(F.col("summary_date") >= batch.date_col)
    aggs = [
        (F.sum(n) if kind == "sum" else F.max(n)).cast(measure_type(n)).alias(n)
        for n, kind in measures
    ]
    return d.groupBy(month_start("summary_date").alias(MONTH), key).agg(
        *aggs,
        F.max("etl_batch_no").alias("etl_batch_no"),
        F.max("etl_batch_date").alias("etl_batch_date"),
    )


def monthly_insert_rows(delta: DataFrame, key: str, measures, batch: Batch) -> DataFrame:
    cols: dict[str, Column] = {MONTH: F.col(MONTH), key: F.col(key)}
    for n, kind in measures:
        cols[n] = F.col(n)
        if kind == "flag":
            cols[n[: -len("_apd")] + "_apm"] = F.col(n)
    cols["dw_create_timestamp"] = batch.ts_col
    cols["dw_update_timestamp"] = batch.ts_col
    cols["etl_batch_no"] = F.col("etl_batch_no")
    cols["etl_batch_date"] = F.col("etl_batch_date")
    return delta.select(*[v.alias(k) for k, v in cols.items()])


def rollforward_parts(monthly: DataFrame, daily: DataFrame, key: str, measures, batch: Batch):
    """(updated monthly table, inserted rows)."""
    keys = [MONTH, key]
    delta = materialize(monthly_delta(daily, key, measures, batch))
    small = fits(delta)
    d = delta.select(*keys, *[F.col(c).alias(f"__d_{c}") for c in delta.columns if c not in keys],
                     F.lit(True).alias("__hit"))
    j = monthly.join(F.broadcast(d) if small else d, keys, "left")
    hit = F.col("__hit").isNotNull()
    new: dict[str, Column] = {}
    for n, kind in measures:
        if kind == "sum":
            new[n] = F.col(n) + F.col(f"__d_{n}")
        else:
            apm = n[: -len("_apd")] + "_apm"
            new[n] = sticky_flag(n, f"__d_{n}")
            new[apm] = sticky_flag(apm, f"__d_{n}")
    new["dw_update_timestamp"] = batch.ts_col
    new["etl_batch_no"] = F.col("__d_etl_batch_no")
    new["etl_batch_date"] = F.col("__d_etl_batch_date")
    cols = monthly_columns(key, measures)
    updated = j.select(*[
        (F.when(hit, new[c].cast(monthly.schema[c].dataType)).otherwise(F.col(c))
         if c in new else F.col(c)).alias(c)
        for c in cols
    ])
    if small:
        present = monthly.select(*keys).join(F.broadcast(delta.select(*keys)), keys, "left_semi")
        fresh = delta.join(present, keys, "left_anti")
    else:
        fresh = delta.join(monthly.select(*keys), keys, "left_anti")
    return updated, monthly_insert_rows(fresh, key, measures, batch).select(*cols)


def rollforward_merge(monthly: DataFrame, daily: DataFrame, key: str, measures, batch: Batch) -> DataFrame:
    updated, inserted = rollforward_parts(monthly, daily, key, measures, batch)
    return updated.unionByName(inserted)


def rollup_months(daily: DataFrame, key: str, measures, batch: Batch) -> DataFrame:
    """First load of a monthly table: the insert half against an empty one."""
    return monthly_insert_rows(monthly_delta(daily, key, measures, None), key, measures, batch) \
        .select(*monthly_columns(key, measures))


def recomputed_months(daily: DataFrame, known: DataFrame, key: str, measures, batch: Batch) -> DataFrame:
    """The rows of whole months from all their ``daily`` rows; rows that are ``known`` keep their creation time."""
    made = rollup_months(daily, key, measures, batch)
    born = known.select(F.col(MONTH).alias("__m"), F.col(key).alias("__k"), F.col("dw_create_timestamp").alias("__born"))
    joined = made.join(born, (F.col(MONTH) == F.col("__m")) & F.col(key).eqNullSafe(F.col("__k")), "left")
    return joined.withColumn("dw_create_timestamp", F.coalesce("__born", "dw_create_timestamp")).select(*made.columns)
