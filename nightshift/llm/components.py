"""Connected components by alternating large-star and small-star rounds.

Every round is a few shuffles over the edge list; no component is ever
gathered in one task or on the driver.  Each round's edges are checkpointed
to the shared folder, so a lost executor never replays earlier rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshift.session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges``.

    The component is the smallest node reachable.  Loops, repeated edges and
    edges with a null end are ignored; no edges give an empty result.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
        .checkpoint()
    )
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        e = _small_star(_large_star(e)).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (
        e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
