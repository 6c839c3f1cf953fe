"""Pick up new landing batches with a file stream (A3 run incrementally)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from nightshift.schemas import SOURCE_SCHEMAS
from nightshift.sources.extract import blanks_as_null


def stage_stream(
    spark: SparkSession,
    table: str,
    landing_root: str,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Stage every landing directory of ``table`` not yet seen, then stop.

    ``sink(staged_rows, micro_batch_id)`` receives each micro-batch with
    blanks turned into NULL and the landing partition column
    ``etl_batch_date``; it is called once per micro-batch (the checkpoint
    makes a restarted stream resume after the last committed one).
    """
    schema = T.StructType(
        SOURCE_SCHEMAS[table].fields + [T.StructField("etl_batch_date", T.DateType())]
    )
    rows = spark.readStream.schema(schema).parquet(f"{landing_root.rstrip('/')}/{table}")
    staged = blanks_as_null(rows)
    return (
        staged.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
