"""I16: dense surrogate ids for new rows, assigned without a global sort task.

The reference relies on an IDENTITY column.  Here new rows are range
partitioned and sorted on their natural key, written once to the reliable
checkpoint folder (so the partition contents are fixed even if an executor
is lost), counted per partition, and numbered ``start + offset(partition) +
position``.  The result equals ``start + row_number() OVER (ORDER BY key)``
and does not depend on the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nightshift.session import ensure_checkpoint_dir


def max_id(df: DataFrame, id_col: str) -> int:
    """Largest id in ``df`` (0 when empty): one scalar to the driver."""
    row = df.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row is not None and row["m"] is not None else 0


def assign_surrogate_keys(
    df: DataFrame, order_cols: list[str], id_col: str, start: int
) -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... in ``order_cols`` order."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    # One row per partition: a bounded relation, numbered in partition order.
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    numbered = ranged.join(F.broadcast(offsets), "__pid").withColumn(
        id_col, (F.lit(start) + F.col("__off") + pos + 1).cast("bigint")
    )
    return numbered.drop("__pid", "__mid", "__off")
