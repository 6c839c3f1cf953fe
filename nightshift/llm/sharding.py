"""Operator 4: sharding along a Hilbert curve, built of DataFrame functions only.

Metadata dimensions (size of the text, language, source, id) are quantised
to cells of a small grid, each document gets its cell's index on the Hilbert
curve, the documents are sorted by that index and the sorted run is cut into
shards whose row counts are at most one apart (law ``rows``).  Neighbours on
the curve are neighbours in every dimension, so a file covers a small box of
the grid and its min/max statistics prune scans in several dimensions.

Quantising is exact arithmetic over the column's own minimum and maximum (one
aggregate): numbers linearly, the size by its bit length, strings by the four
bytes that follow the prefix which all values share (the smallest and the
largest value share it, so all do).  Ranks need no global sort task: rows
are range-partitioned on (index, id, checksum, size), every partition counts
its rows, and a table of one row per partition carries the offsets.

Nulls and empties: a null text has no bytes (size 16, checksum 0); a null in
a dimension falls into its first cell, a null id sorts first; an empty table
gives an empty result.  Equal rows get neighbouring slots in either order.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from nightshift.llm.common import cut

SHARDS = 40
ROW_BYTES = 16
GRID_BITS = 4


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a cell with ``bits`` bits in each of its dimensions.

    Folds over (bit, dimension), highest bit first: where the dimension's bit
    is set the lower bits of the first coordinate are inverted, else they are
    exchanged with the dimension's; then the Gray code is undone and the
    coordinates' bits are interleaved.
    """
    n = len(cells)
    steps = F.array(*[
        F.struct(F.lit(1 << b).alias("q"), F.lit(d).alias("d")) for b in range(bits - 1, 0, -1) for d in range(n)
    ])

    def turn(x: Column, step: Column) -> Column:
        low = step["q"] - 1
        first, own = F.get(x, F.lit(0)), F.get(x, step["d"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        is_set = own.bitwiseAND(step["q"]) != 0
        return F.transform(
            x,
            lambda v, i: F.when(is_set, F.when(i == 0, v.bitwiseXOR(low)).otherwise(v))
            .when((i == 0) | (i == step["d"]), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    turned = F.aggregate(steps, F.array(*[c.cast("int") for c in cells]), turn)
    # Bit by bit: the running exclusive or over coordinates undoes the Gray
    # code within a bit, the parity of the last coordinate's higher bits
    # undoes it between bits.
    levels = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])

    def digit(state: Column, b: Column) -> Column:
        def one(s: Column, v: Column) -> Column:
            bit = F.pmod(F.call_function("shiftright", v, b), F.lit(2))
            parity = s["parity"].bitwiseXOR(bit)
            return F.struct((s["index"] * 2 + parity).alias("index"), parity.alias("parity"))

        return F.aggregate(state["x"], F.struct(state["index"].alias("index"), state["parity"].alias("parity")), one, lambda s: F.struct(state["x"].alias("x"), s["index"].alias("index"), s["parity"].alias("parity")))

    start = F.struct(turned.alias("x"), F.lit(0).cast("long").alias("index"), F.lit(0).alias("parity"))
    return F.aggregate(levels, start, digit, lambda s: s["index"])


def _linear(value: Column, low: int, high: int, bits: int) -> Column:
    """``value`` between ``low`` and ``high`` as one of 2^bits cells; null is cell 0."""
    step = (value.cast("decimal(20,0)") - low) * (1 << bits) / (high - low + 1)
    return F.coalesce(F.floor(step).cast("int"), F.lit(0))


def _shared_bytes(low: str, high: str) -> int:
    """How many leading bytes ``low`` and ``high`` share."""
    a, b = low.encode("utf-8"), high.encode("utf-8")
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def grid_cells(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """The cell of every row in each of ``dims`` (numbers or strings)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # Two scalars a dimension come to the driver.
    ends = df.agg(*[f(F.col(d)).alias(f"{k}_{d}") for d in dims for k, f in (("low", F.min), ("high", F.max))]).first()
    cells = []
    for d in dims:
        low, high, value = ends[f"low_{d}"], ends[f"high_{d}"], F.col(d)
        if low is None:
            cells.append(F.lit(0))
            continue
        if isinstance(kinds[d], T.StringType):
            skip = _shared_bytes(low, high)
            low, high = (int.from_bytes(x.encode("utf-8")[skip : skip + 4].ljust(4, b"\0")) for x in (low, high))
            part = F.hex(F.substring(value.cast("binary"), skip + 1, 4))
            value = F.conv(F.rpad(part, 8, "0"), 16, 10)
        cells.append(_linear(value, low, high, bits))
    return cells


def ranked(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with its rank (from 0) by ``order``, without a task that sees all rows."""
    placed = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()),
        "shard-order",
    )
    part, at = F.shiftright("__m", 33), F.col("__m").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition.
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__off"))
    return placed.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(out, F.col("__off") + at).drop("__m", "__part", "__off")


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = GRID_BITS) -> DataFrame:
    """``(doc_id, size, text_crc32, hilbert, shard, slot)`` per row; see the module docstring."""
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    size = F.octet_length(raw).cast("long") + ROW_BYTES
    rows = docs.select(
        "doc_id", size.alias("size"), F.crc32(raw).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
    )
    # Twice the bit length and the bit below the top: half-octaves of the size.
    octave = F.length(F.bin("size"))
    half = F.pmod(F.call_function("shiftright", F.col("size"), F.greatest(octave - 2, F.lit(0))), F.lit(2))
    rows = rows.withColumn("scale", 2 * octave + half)
    cells = grid_cells(rows, ["scale", "lang", "source", "doc_id"], bits)
    keyed = rows.select("doc_id", "size", "text_crc32", hilbert_index(cells, bits).alias("hilbert"))
    order = ranked(keyed, ["hilbert", "doc_id", "text_crc32", "size"], "rank")
    total = max(1, order.count())
    # Shard s begins at rank ceil(s * total / shards).
    cutting = order.withColumn("shard", F.expr(f"(rank * {shards}) div {total}"))
    return cutting.select(
        "doc_id", "size", "text_crc32", "hilbert", F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - F.expr(f"(shard * {total} + {shards - 1}) div {shards}")).cast("long").alias("slot"),
    )


def shard_digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    placed = hilbert_shards(docs, shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` under ``path``, one ``shard=<n>`` folder per shard, rows in curve order.

    A document's rows are found by (doc_id, checksum); rows equal in both
    stay together in the first of their shards.
    """
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    where = hilbert_shards(docs, shards).groupBy("doc_id", "text_crc32").agg(F.min(F.struct("shard", "slot")).alias("at"))
    where = where.select(F.col("doc_id").alias("__d"), F.col("text_crc32").alias("__c"), "at.shard", F.col("at.slot").alias("__slot"))
    own = docs.drop("shard")
    joined = own.join(where, own["doc_id"].eqNullSafe(where["__d"]) & (F.crc32(raw) == where["__c"]))
    (joined.repartitionByRange("shard", "__slot").sortWithinPartitions("shard", "__slot")
     .drop("__d", "__c", "__slot").write.partitionBy("shard").parquet(path))
