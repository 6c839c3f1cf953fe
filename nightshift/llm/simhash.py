"""Operator 9: SimHash near-dedup by covering locality-sensitive hashing.

Every whole text gets a 64-bit SimHash of its word shingles.  Copies of a
fingerprint collapse first.  For radius r, every bit position i is given the
nonzero vector ``phi(i)`` of r + 1 bits, and table v (any nonzero vector)
keeps the bits whose vector is not orthogonal to v.  The vectors of at most
r differing positions span at most r dimensions, so some v is orthogonal to
all of them: every pair within the radius shares its key in some of the
2^(r+1) - 1 tables.  Pairs inside a bucket are verified by their bit
distance.

A bucket of more than ``bucket_pairs`` fingerprints isn't paired.  Its
members go an exact way without pairs: each is sent to all values within
ceil(r/2) flipped bits.  What meets at a value is bounded by geometry (65
fingerprints for r = 2), any two within the radius meet somewhere, and each
value emits one star of links.

Nulls and empties: a null text counts as empty; without words the
fingerprint is zero and links like any other.  A row whose doc_id is null
keeps its fingerprint and gets the component of the other rows with that
fingerprint (null when there is none).  Equal rows are all returned.  An
empty table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import copies_apart, cut, hex64
from nightshift.llm.components import connected_components

BITS = 64
SEED = 42
BUCKET_PAIRS = 32
BLOCK = 1 << 16


def simhash64(text: str | None, shingle: int) -> int:
    """SimHash as a signed 64-bit int: bit b is 1 if set in over half of the hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.array(hashes[at : at + BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([simhash64(t, shingle) for t in batch], dtype="int64")

    return fingerprint


def covering_masks(radius: int) -> list[int]:
    """The bit masks of the tables, as unsigned ints."""
    vectors = (1 << (radius + 1)) - 1
    phi = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (phi[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(most: int) -> list[int]:
    return [_signed(sum(1 << i for i in c)) for n in range(most + 1) for c in combinations(range(BITS), n)]


def fingerprint_links(prints: DataFrame, radius: int, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` within ``radius`` bits.

    From small buckets all such pairs; from large ones stars that connect
    the same fingerprints.  Every link is between fingerprints within the
    radius.
    """
    masks = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(covering_masks(radius))])
    keyed = prints.select("fp", F.explode(masks).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cut(keyed.join(sizes, ["t", "key"]), "simhash-buckets")

    small = held.where(F.col("n") <= bucket_pairs)
    left, right = small.select("t", "key", F.col("fp").alias("a")), small.select("t", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = left.join(right, ["t", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")

    within, beyond = radius // 2, radius - radius // 2
    full = held.where(F.col("n") > bucket_pairs).select("fp").distinct()
    flips = _flips(beyond)
    inner = len(_flips(within))
    met = full.select("fp", F.posexplode(F.array(*[F.lit(x) for x in flips]))).select(
        F.col("fp").alias("b"), F.col("fp").bitwiseXOR(F.col("col")).alias("value"), (F.col("pos") < inner).alias("inner")
    )
    centre = met.where("inner").groupBy("value").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n"))
    # A value that only one fingerprint reaches links nothing.
    stars = met.join(centre, "value").where("a != b").select("a", "b")
    return pairs.unionByName(stars).distinct()


def simhash_components(
    docs: DataFrame, shingle: int = 5, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
    bucket_pairs: int = BUCKET_PAIRS,
) -> DataFrame:
    """``(doc_id, fp, text_hash, component_id)`` per row of ``docs``; see the module docstring."""
    fp, text = fingerprint_udf(shingle), F.col(text_col).cast("string")
    prints = cut(docs.select(F.col(id_col).alias("doc_id"), fp(text).alias("fp"), F.xxhash64(text).alias("text_hash")), "simhash")
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    links = fingerprint_links(classes.where(F.col("rep").isNotNull()), max_bits, bucket_pairs)
    rep = classes.select(F.col("fp"), F.col("rep"))
    edges = (
        links.join(rep.select(F.col("fp").alias("a"), F.col("rep").alias("x")), "a")
        .join(rep.select(F.col("fp").alias("b"), F.col("rep").alias("y")), "b")
        .select("x", "y")
    )
    found = connected_components(edges, "x", "y")
    named = rep.join(found, rep["rep"] == found["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(named, "fp").select("doc_id", "fp", "text_hash", "component_id")


def simhash_digest(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    found = simhash_components(docs, shingle, max_bits)
    return found.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first_of_group(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """One row of each group stays: the first by doc_id (nulls last), hash of the text, copy of the row.

    Rows with a null doc_id are in the group of the rows with their
    fingerprint; where none of those has an id, they are a group of their own.
    """
    found = simhash_components(docs, shingle, max_bits)
    alone = F.when(F.col("component_id").isNull(), F.col("fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = found.groupBy("component_id", alone.alias("alone")).agg(F.min(order).alias("f")).select(
        F.col("f.doc_id").alias("__d"), F.col("f.text_hash").alias("__t"))
    here = docs["doc_id"].eqNullSafe(first["__d"]) & (F.xxhash64(docs["text"].cast("string")) == first["__t"])
    return copies_apart(docs.join(first, here, "left_semi")).where(~F.col("__again")).drop("__again")
