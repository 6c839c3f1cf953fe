"""Join helpers: size-checked broadcast, lookups and anti joins.

Broadcasting is only ever decided behind a measured size: one aggregate over
the side gives its row count and the bytes of its texts and other columns of
variable width, to which the fixed columns' widths are added.  The side is
broadcast only when both the rows and the bytes are within their limits.
Beyond them the ordinary shuffle join (with AQE's runtime re-planning and
skew splitting) is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
CONF_ROWS = "spark.nightshift.broadcastMaxRows"
CONF_BYTES = "spark.nightshift.broadcastMaxBytes"

# Rows dealt to a task: within some 300 MB also where a task sorts and aggregates them.
ROWS_A_TASK = 500_000

# A row in memory: a header, then eight bytes per column (decimals up to 16).
ROW_HEADER = 16
FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)


def _size_columns(df: DataFrame) -> list[Column]:
    """Aggregates for the row count and the bytes of ``df`` in memory."""
    fields = df.schema.fields
    fixed = ROW_HEADER + sum(16 if isinstance(f.dataType, T.DecimalType) else 8 for f in fields)
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)).cast("bigint")
            for f in fields if not isinstance(f.dataType, FIXED)]
    each = sum(wide, F.lit(fixed).cast("bigint"))
    return [F.count(F.lit(1)).alias("__rows"), F.coalesce(F.sum(each), F.lit(0)).alias("__bytes")]


def _within(df: DataFrame, rows: int, size: int, max_rows: int | None = None) -> bool:
    conf = df.sparkSession.conf
    row_limit = int(conf.get(CONF_ROWS, None) or DEFAULT_BROADCAST_ROWS) if max_rows is None else max_rows
    return rows <= row_limit and size <= int(conf.get(CONF_BYTES, None) or DEFAULT_BROADCAST_BYTES)


def fits(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` is measured to be within the limits for a broadcast."""
    got = df.agg(*_size_columns(df)).first()
    return _within(df, got["__rows"], got["__bytes"], max_rows)


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its measured size is within the limits, else ``df``."""
    return F.broadcast(df) if fits(df, max_rows) else df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``keys``: a task gets about ``ROWS_A_TASK`` rows at most, however many there are.

    Aggregations and joins on the keys that follow need no other exchange.
    Small inputs are left to AQE, which never makes fewer tasks than cores.
    """
    spark = df.sparkSession
    n = rows // ROWS_A_TASK + 1
    if n <= spark.sparkContext.defaultParallelism:
        return df.repartition(*keys)
    # Spark deals both sides of a join anew when one has fewer partitions than its default.
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def with_keys_of(big: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``big`` without the rows whose key ``small`` lacks, if the keys may be broadcast, else ``big``.

    Spark moves such a semi join below an aggregation by the key (and below
    its exchange), which an inner join with ``small`` alone does not.
    """
    keys = small.select(key)
    return big.join(F.broadcast(keys), key, "left_semi") if fits(keys) else big


def lookup(
    rows: DataFrame,
    parent: DataFrame,
    row_col: str,
    parent_key: str,
    parent_id: str,
    out_col: str,
    required: bool,
    small_rows: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``parent.parent_id`` as ``out_col`` by ``row_col = parent_key``.

    Optional lookups keep unmatched rows with a NULL id (left outer join);
    required ones drop them (inner join, the reference's LEFT JOIN + IS NOT
    NULL, which Catalyst would otherwise keep as an outer join + filter).
    """
    ids = parent.select(
        F.col(parent_key).alias("__lk_key"), F.col(parent_id).alias(out_col)
    ).where(F.col("__lk_key").isNotNull())
    if required:
        ids = ids.where(F.col(out_col).isNotNull())
    if small_rows:
        # Few rows to look up: cut the parent down map-side first, so a large
        # parent is scanned but never shuffled.  ``keys_from`` (a superset of
        # ``rows`` with the same column) avoids re-running earlier lookups.
        source = rows if keys_from is None else keys_from
        wanted = source.select(F.col(row_col).alias("__lk_key"))
        ids = ids.join(F.broadcast(wanted), "__lk_key", "left_semi")
    joined = rows.join(ids, rows[row_col] == ids["__lk_key"], "inner" if required else "left")
    return joined.drop("__lk_key")


def new_keys(rows: DataFrame, existing: DataFrame, keys: list[str], existing_keys: list[str]) -> DataFrame:
    """Rows whose key is absent from ``existing`` (explicit left anti join)."""
    ex = existing.select(*[F.col(e).alias(k) for k, e in zip(keys, existing_keys)])
    return rows.join(ex, keys, "left_anti")


def join_small_side(big: DataFrame, small: DataFrame, key: str, how: str = "inner", stored_by: str | None = None) -> DataFrame:
    """``big`` joined with a usually-small ``small`` side on ``key``.

    ``stored_by`` names a column that both sides hold for the same key and by
    which ``big`` is partitioned on disk: as a join key it lets Spark prune
    the partitions of ``big`` by those of ``small`` when the join starts.

    One aggregate over ``small`` gives its size and key range.  The
    range becomes a plain ``key BETWEEN lo AND hi`` filter on ``big``, which
    Parquet turns into row-group skipping when ``big`` is clustered on the
    key (tables written in id order are); the size decides the broadcast.
    Both are exact: rows of ``big`` outside the range cannot match.
    """
    stats = small.agg(*_size_columns(small), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = stats["lo"], stats["hi"]
    if lo is None:
        big = big.where(F.lit(False))
    else:
        big = big.where(F.col(key).between(F.lit(lo), F.lit(hi)))
    if not _within(small, stats["__rows"], stats["__bytes"]):
        return big.join(small, [key, stored_by] if stored_by else key, how)
    if stored_by is None and how == "inner":
        # Where ``big`` is made by an aggregation, its input is cut down too.
        big = big.join(F.broadcast(small.select(key)), key, "left_semi")
    return big.join(F.broadcast(small), [key, stored_by] if stored_by else key, how)
