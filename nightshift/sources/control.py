"""Batch control and its log.

``batch_control`` holds (etl_batch_no, etl_batch_date); the current batch is
the one with the highest number (the reference's ORDER BY ... DESC LIMIT 1;
a top-1, computed per partition and merged).  ``batch_control_log`` gets
one row per run: appended with status 'R' at the start, set to 'S' (or 'F')
with an end time at the end, on every row of that batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshift.schemas import LOG_RUNNING, LOG_SUCCEEDED

LOG_SCHEMA = T.StructType([
    T.StructField("etl_batch_no", T.IntegerType()),
    T.StructField("etl_batch_date", T.DateType()),
    T.StructField("etl_batch_status", T.StringType()),
    T.StructField("etl_batch_start_time", T.TimestampNTZType()),
    T.StructField("etl_batch_end_time", T.TimestampNTZType()),
])


def _ts(value: dt.datetime):
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def current_batch(control: DataFrame) -> DataFrame:
    """A5 / F1: the row with the highest batch number (one row)."""
    return control.select("etl_batch_no", "etl_batch_date").orderBy(
        F.col("etl_batch_no").desc()
    ).limit(1)


def log_start(log: DataFrame, current: DataFrame, start: dt.datetime) -> DataFrame:
    """Append (no, date, 'R', start, NULL) for the current batch."""
    row = current.select(
        F.col("etl_batch_no").cast("int").alias("etl_batch_no"),
        F.col("etl_batch_date").cast("date").alias("etl_batch_date"),
        F.lit(LOG_RUNNING).alias("etl_batch_status"),
        _ts(start).alias("etl_batch_start_time"),
        F.lit(None).cast("timestamp_ntz").alias("etl_batch_end_time"),
    )
    return log.select(*LOG_SCHEMA.fieldNames()).unionByName(row)


def log_end(log: DataFrame, current: DataFrame, end: dt.datetime,
            status: str = LOG_SUCCEEDED) -> DataFrame:
    """Status and end time on every log row of the current batch."""
    # ``current`` is a single row (a LIMIT 1): broadcasting it is bounded.
    hit = F.broadcast(current.select("etl_batch_no", "etl_batch_date", F.lit(True).alias("__hit")))
    j = log.join(hit, ["etl_batch_no", "etl_batch_date"], "left")
    match = F.col("__hit").isNotNull()
    return j.select(
        "etl_batch_no",
        "etl_batch_date",
        F.when(match, F.lit(status)).otherwise(F.col("etl_batch_status")).alias("etl_batch_status"),
        "etl_batch_start_time",
        F.when(match, _ts(end)).otherwise(F.col("etl_batch_end_time")).alias("etl_batch_end_time"),
    )
