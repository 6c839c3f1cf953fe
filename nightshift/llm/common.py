"""Small helpers the operators share: reading tables, cutting lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshift.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path is only ever opened by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage so that a lost executor re-reads files instead of
    recomputing, and gives the planner a measured size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def hex64(col: Column) -> Column:
    """A 64-bit value as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def copies_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__again``: whether a row equals an earlier one in doc_id and text (nulls equal each other)."""
    hashed = F.xxhash64(F.col("text").cast("string"))
    again = docs.select(F.col("doc_id").alias("__d"), hashed.alias("__t")).groupBy("__d", "__t").agg(F.count(F.lit(1)).alias("__n"))
    again = cut(again.where("__n > 1").select("__d", "__t"), "copies")
    if again.isEmpty():
        return docs.withColumn("__again", F.lit(False))
    same = docs["doc_id"].eqNullSafe(again["__d"]) & (hashed == again["__t"])
    # Written with a number of its own for each row, so that every reader means the same copy.
    held = cut(docs.join(again, same).withColumn("__row", F.monotonically_increasing_id()), "copies-rows")
    least = held.groupBy(F.col("__d").alias("__g"), F.col("__t").alias("__h")).agg(F.min("__row").alias("__first"))
    marked = held.join(least, F.col("__d").eqNullSafe(F.col("__g")) & (F.col("__t") == F.col("__h")))
    repeats = marked.withColumn("__again", F.col("__row") > F.col("__first")).select(*docs.columns, "__again")
    return docs.join(again, same, "left_anti").withColumn("__again", F.lit(False)).unionByName(repeats)
