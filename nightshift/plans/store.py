"""Warehouse tables on plain Parquet: a folder for each table, partitioned by ``tables.LAYOUT``.

A program hands over whole partitions, those that its batch touches, and
Spark's dynamic partition overwrite replaces them (it stages the new files
first, so a program may read the table that it writes).  Everything else
stays as it is on disk.  Each table is published on its own, as soon as its
program is done; what says that a batch is complete is its 'S' row in the
batch log.  A batch that failed is run again: every program gives the same
table when it is repeated (see ``run.run_batch``).

Known limit: Spark swaps the folders of a write one after another when all
its tasks are done.  A driver that dies within that moment can leave some of
them unswapped; running the batch again writes them anew, except those that
were already removed, which plain Parquet can't prevent.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshift.plans.tables import ID_WIDTH, LAYOUT, LOG, TABLES, table_schema
from nightshift.schemas import LOG_SUCCEEDED
from nightshift.sources.control import LOG_SCHEMA


class Store:
    """The warehouse under ``root``; ``id_width`` is the number of ids in a range partition."""

    def __init__(self, spark: SparkSession, root: str, id_width: int = ID_WIDTH):
        self.spark = spark
        self.root = root.rstrip("/")
        self.id_width = id_width

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # -- reading ---------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """The rows of ``table`` as last published, none before its first load."""
        if table == LOG:
            return self.read_log()
        return self._rows(self.path(table), table_schema(table))

    def _rows(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def tables(self) -> list[str]:
        return list(TABLES)

    def create(self) -> None:
        """Make the tables, without rows, where there are none yet."""
        for t in TABLES:
            rows = self.spark.createDataFrame([], table_schema(t))
            rows.write.mode("append").partitionBy(*LAYOUT[t]).parquet(self.path(t))

    # -- writing ---------------------------------------------------------------
    def replace_parts(self, table: str, rows: DataFrame) -> None:
        """Publish ``rows`` as the whole content of the partitions that they lie in."""
        names = table_schema(table).fieldNames()
        (rows.select(*names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*LAYOUT[table]).parquet(self.path(table)))

    def write_facts(self, table: str, rows: DataFrame, batch_no: int, sort_cols: list[str] | None = None) -> None:
        """Publish one batch's daily rows as ``etl_batch_no=<no>/summary_month=<m>``.

        The batch's folder is replaced as a whole, so a batch that runs again
        leaves no month of its earlier run behind.
        """
        # A row of another batch is an error of the program, not a row to skip.
        own = F.col("etl_batch_no").eqNullSafe(F.lit(batch_no))
        wrong = F.raise_error(F.lit(f"{table}: a row of another batch than {batch_no}")).cast("boolean")
        out = rows.where(F.when(own, F.lit(True)).otherwise(wrong)).drop("etl_batch_no")
        out = out.withColumn("summary_month", F.trunc("summary_date", "month"))
        if sort_cols:
            # rows laid out in (date, id) order inside each file.
            out = out.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols)
        out.write.mode("overwrite").partitionBy("summary_month").parquet(f"{self.path(table)}/etl_batch_no={batch_no}")

    def clear(self, table: str, **part) -> None:
        """Leave the named partition without rows."""
        folder = "/".join(f"{c}={part[c]}" for c in LAYOUT[table])
        fields = [f for f in table_schema(table).fields if f.name not in part]
        self.spark.createDataFrame([], T.StructType(fields)).write.mode("overwrite").parquet(f"{self.path(table)}/{folder}")

    # -- the batch log ------------------------------------------------------------
    def write_log(self, row: DataFrame) -> None:
        """Add one status row of a batch: visible at once, never replaced."""
        row.select(*LOG_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(self.path(LOG))

    def read_log(self) -> DataFrame:
        """One row per run of a batch with its latest status; failed runs stay."""
        rows = self._rows(self.path(LOG), LOG_SCHEMA)
        # A running row has no end time, a final one replaces it; of two final
        # rows of one run (same start time) the later and then the good one counts.
        rank = F.struct(F.col("etl_batch_end_time").isNotNull(), "etl_batch_end_time", F.col("etl_batch_status") == LOG_SUCCEEDED)
        last = F.max_by(F.struct("etl_batch_status", "etl_batch_end_time"), rank)
        return rows.groupBy("etl_batch_no", "etl_batch_date", "etl_batch_start_time").agg(last.alias("l")).select(
            "etl_batch_no", "etl_batch_date", "l.etl_batch_status", "etl_batch_start_time", "l.etl_batch_end_time")

    def complete_batch(self) -> int | None:
        """Number of the newest batch that is complete (None before the first)."""
        return self.read_log().where(F.col("etl_batch_status") == LOG_SUCCEEDED).agg(F.max("etl_batch_no")).first()[0]

    def unfinished(self, below: int) -> list[int]:
        """Batches that were begun, up to number ``below``, and are not complete."""
        done = F.max(F.col("etl_batch_status") == LOG_SUCCEEDED)
        runs = self.read_log().where(F.col("etl_batch_no") <= below).groupBy("etl_batch_no").agg(done.alias("done"))
        # A batch must be complete before the next one starts: one row at most, but for old logs.
        return sorted(r["etl_batch_no"] for r in runs.where("NOT done").collect())
