"""Extract, land and stage.

* ``extract_incremental`` (A1): the fixed column list of a source table,
  rows whose update day is on or after the batch date.  Written as a date
  comparison so that it is pushed to the source (JDBC) or the Parquet scan.
* ``land`` (A2): the extract written under ``landing/<table>/etl_batch_date=<d>``;
  a rerun of the batch overwrites it.  Parquet by default; CSV with a header
  when asked, with options that survive commas, quotes, newlines and outer
  blanks.  No single-file coalesce: every task writes its own part.
* ``stage_load`` (A3 + A4): read one batch's landing files with the
  explicit schema, then empty / blank text -> NULL on every text column.
* ``read_jdbc_incremental``: A1 against a live database (the reference's
  database extract), partitioned on the natural key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshift.functions import blank_as_null, on_or_after
from nightshift.schemas import SOURCE_SCHEMAS
from nightshift.session import scratch_path

# CSV options for both directions: quote-escaped, nothing trimmed, a header
# line, multi-line values allowed (landing CSV is small per batch).
CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# NULL is written as an empty unquoted field and "" as a quoted one; reading
# with a NUL marker as nullValue keeps the two apart (with the default they
# would both come back NULL).
CSV_READ = {**CSV_WRITE, "multiLine": "true", "mode": "FAILFAST", "nullValue": "\u0000"}


def extract_incremental(source: DataFrame, table: str, batch_date: dt.date) -> DataFrame:
    """A1: the table's extract columns, rows updated on/after the batch date."""
    cols = [f.name for f in SOURCE_SCHEMAS[table].fields]
    return source.select(*cols).where(on_or_after("update_timestamp", batch_date))


def blanks_as_null(df: DataFrame) -> DataFrame:
    """A4: empty or all-blank text becomes NULL on every string column."""
    return df.select(*[
        blank_as_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def landing_path(spark: SparkSession, table: str, batch_date: dt.date, root: str | None = None) -> str:
    base = root or scratch_path(spark, "landing")
    return f"{base.rstrip('/')}/{table}/etl_batch_date={batch_date.isoformat()}"


def land(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A2: write one batch's extract (overwrite = rerun-safe)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.parquet(path)
    return path


def stage_load(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A3 + A4: one batch's landing files with the fixed schema, blanks -> NULL."""
    schema = SOURCE_SCHEMAS[table]
    if fmt == "csv":
        df = spark.read.schema(schema).options(**CSV_READ).csv(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    return blanks_as_null(df.select(*[f.name for f in schema.fields]))


def read_jdbc_incremental(
    spark: SparkSession,
    url: str,
    table: str,
    batch_date: dt.date,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A1 against a database: a key-partitioned JDBC read, cutoff pushed down."""
    src = spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                          numPartitions=partitions, properties=properties or {})
    return extract_incremental(src, table, batch_date)
