"""Operator 12: Merkle dataset manifest with nested-interval labels.

Every row of ``documents`` is a leaf: the digest of its fields, each written
as ``-`` (null) or byte count, ``:`` and value, so no two rows share an
encoding.  Leaves are ranked within their group (language) by id, and every
node carries the interval ``[lo, hi)`` of leaf ranks that it covers.

1. Ranks come from a range sort and the counts of its partitions, so no group
   is gathered in one task, however large.
2. Up: the nodes of level k whose intervals fall into one bucket of
   ``FAN ** (k + 1)`` ranks become one node of level k + 1.  A run is at most
   ``FAN`` digests; each level has an eighth of the rows of the one below.
3. The groups' subroots, ranked by group, are the leaves of a second tree.
4. Down: a node finds its parent by a containment join: both sides are
   bucketed by the parent's level, ``lo div FAN ** (k + 1)`` is the key, and the
   parent's interval must contain the node's.  Siblings are the difference of
   the two intervals: the parent's children that end at ``lo`` or before it
   (left), and those that begin at ``hi`` or after it (right).  A node's proof is
   its own (left, right) followed by its parent's proof, so proofs are made
   once per node and a leaf only meets its level-1 parent.

Verification folds a leaf with its proof up to the root.

Nulls and empties: a null field is ``-``, an empty text ``0:``; null languages
form a group of their own, which comes first; null ids come first in their
group; rows that repeat are leaves of their own, next to each other (their
order can't be told); rows with one id and other fields are ordered by leaf
digest; a group of one leaf has that leaf as subroot, a table of one group
its subroot as root; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut, lower_ascii
from nightshift.operators.joins import bounded_broadcast
from nightshift.operators.surrogate import assign_surrogate_keys

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def field(value: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus their rank within ``group`` (from 0, by ``order``) as interval ``[lo, hi)``, and the group's size ``n``."""
    placed = assign_surrogate_keys(rows, [group, *order], "place", 0)
    sizes = placed.groupBy(F.col(group).alias("__g")).agg(F.min("place").alias("__first"), F.count(F.lit(1)).alias("n"))
    joined = placed.join(bounded_broadcast(cut(sizes, "merkle-groups")), F.col(group).eqNullSafe(F.col("__g")))
    lo = F.col("place") - F.col("__first")
    return joined.select(*rows.columns, lo.alias("lo"), (lo + 1).alias("hi"), "n")


def _bucket(level: int) -> Column:
    """The bucket of the parents of ``level``: the number of the interval of ``FAN ** level`` ranks that a node lies in."""
    return F.floor(F.col("lo") / F.lit(FAN**level)).cast("long")


def parents(nodes: DataFrame, group: str, level: int) -> DataFrame:
    """The nodes of ``level`` over those below; groups of one node have none."""
    child = F.struct("lo", "hi", "digest")
    runs = nodes.where("n > 1").groupBy(group, _bucket(level).alias("bucket")).agg(
        F.sort_array(F.collect_list(child)).alias("children"), F.max("n").alias("below")
    )
    return runs.select(
        group, "bucket", "children", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
        F.sha2(F.array_join("children.digest", ""), 256).alias("digest"), F.ceil(F.col("below") / FAN).cast("long").alias("n"),
    )


def grow(leaves: DataFrame, group: str, name: str) -> list[DataFrame]:
    """The levels over ``leaves``: ``levels[k]`` are the nodes of level k + 1, down to one node for each group."""
    below, levels = leaves, []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = cut(parents(below, group, len(levels) + 1), f"merkle-{name}-{len(levels) + 1}")
        levels.append(below)
        most = -(-most // FAN)
    return levels


def tops(leaves: DataFrame, levels: list[DataFrame], group: str) -> DataFrame:
    """``(group, digest)`` of the node that remains in each group."""
    every = [x.where("n = 1").select(group, "digest") for x in [leaves, *levels]]
    return reduce(DataFrame.unionByName, every)


def _siblings() -> Column:
    """What the interval of the node leaves of its parent's: the digests before and behind it."""
    left = F.filter("__children", lambda c: c["hi"] <= F.col("lo"))
    right = F.filter("__children", lambda c: c["lo"] >= F.col("hi"))
    return F.struct(
        F.array_join(F.transform(left, lambda c: c["digest"]), "").alias("left"),
        F.array_join(F.transform(right, lambda c: c["digest"]), "").alias("right"),
    )


def under(nodes: DataFrame, above: DataFrame, group: str, level: int, carried: list[str]) -> DataFrame:
    """``nodes`` with the proof that they inherit from the nodes ``above`` (of ``level``) that contain them."""
    # The null group's key joins like any other.
    key = [F.col(group).isNull().alias("__none"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("__key")]
    held = above.select(
        *key, F.col("bucket").alias("__at"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
        F.col("children").alias("__children"), F.col("proof").alias("__proof"), *carried,
    )
    own = nodes.select("*", *key, _bucket(level).alias("__at"))
    joined = own.join(held, ["__none", "__key", "__at"]).where((F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi")))
    proof = F.concat(F.array(_siblings()), F.col("__proof"))
    return joined.select(*nodes.columns, proof.alias("proof"), *carried)


def _with_top(nodes: DataFrame, top: DataFrame, group: str, carried: list[str]) -> DataFrame:
    """The nodes that remain in their group with the proof of their subroot."""
    last = top.select(F.col(group).alias("__top"), "proof", *carried)
    return nodes.where("n = 1").join(last, F.col(group).eqNullSafe(F.col("__top"))).drop("__top")


def proven(leaves: DataFrame, levels: list[DataFrame], top: DataFrame, group: str, carried: list[str]) -> DataFrame:
    """``leaves`` with their proofs; ``top`` has ``(group, proof, *carried)`` of each group's remaining node."""
    out = _with_top(leaves, top, group, carried)
    above = None
    for k in range(len(levels), 0, -1):
        nodes = levels[k - 1]
        known = _with_top(nodes, top, group, carried)
        above = known if above is None else known.unionByName(under(nodes.where("n > 1"), above, group, k + 1, carried))
    return out if above is None else out.unionByName(under(leaves.where("n > 1"), above, group, 1, carried))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` gives with a proof."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` (with their ``digest``) plus ``subroot``, ``root`` and ``proof``: the steps ``(left, right)`` from leaf to root."""
    leaves = cut(ranked(rows, group, [*order, "digest"]), "merkle-leaves")
    levels = grow(leaves, group, "group")
    subroots = tops(leaves, levels, group).withColumn("whole", F.lit(0))
    # The second tree: one group, whose leaves are the subroots.
    seconds = cut(ranked(subroots, "whole", [group]), "merkle-subroots")
    upper = grow(seconds, "whole", "whole")
    root = tops(seconds, upper, "whole").select("whole", F.col("digest").alias("root")).withColumn("proof", F.array().cast(f"array<{STEP}>"))
    roots = proven(seconds, upper, root, "whole", ["root"]).select(group, F.col("digest").alias("subroot"), "root", "proof")
    return proven(leaves, levels, cut(roots, "merkle-roots"), group, ["subroot", "root"]).drop("lo", "hi", "n")


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, each row checked after the tampering that the query states."""
    lowered = lower_ascii(F.col("text").cast("string"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        "doc_id", "lang", leaf_digest().alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(text=lowered)).alias("tampered"),
    )
    held = manifest(cut(rows, "merkle-rows"), "lang", ["doc_id"])
    again = folded(F.coalesce("tampered", "digest"), F.col("proof"))
    shown = held.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), again.alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
