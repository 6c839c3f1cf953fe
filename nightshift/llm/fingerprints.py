"""Operator 1: document fingerprints by SpotSigs.

Anchors are the corpus's common words, the ``COMMON`` words that most documents
hold, counted over all documents (``common_words``).  Each anchor forms a
signature: the word and the chain of the next ``CHAIN`` content words, those
that are not common; at the end of the text a chain is filled with an end
mark.  Where no common word stands within ``GAP`` words, the word with the
least hash of them is an anchor as well, so every ``GAP`` words in a row hold one;
that choice depends on those words alone and is the same for all lengths and
languages.  A text's fingerprint is its set of signature hashes (32 bits
each), written as sorted hex digits.

``near_duplicates`` finds all pairs of fingerprints with a Jaccard similarity
of at least a threshold: copies collapse, sets are partitioned by their
length so that only sets of one or two neighbouring partitions can match, and
what shares a prefix signature there is compared through a pruned Jaccard
that stops as soon as the threshold is out of reach.

``next_document`` order: documents are cut into ranges of doc_id at
quantiles; each range also gets a copy of the first document of the next
range (the last: of the first), so every task streams its sorted range with
all it needs and texts are shuffled once.

Nulls and empties: a null text counts as empty; texts without words have the
empty fingerprint, as like another empty one as can be (1) and unlike any
other (0); null doc_ids sort first and rows with the same doc_id are ordered
by text; a single document is its own next; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut, text_of

#: Common words of a corpus, and the words in a row that hold an anchor.
COMMON = 64
GAP = 4
CHAIN = 2
EDGES = ".,;:!?\"'()[]{}<>-_*#~`|/\\"
CACHED_WORDS = 300_000
RANGE_ROWS = 1_000
#: Ranges are compared with each row's id, so their number has a bound; a range is streamed, whatever its length.
MAX_RANGES = 16_384

DIGEST = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_signatures long"
)


def common_words(docs: DataFrame, size: int = COMMON) -> list[str]:
    """The ``size`` words that most documents hold (ties: smallest first), over all documents."""
    tokens = F.array_distinct(F.split(F.lower(text_of(F.col("text"))), r"\s+"))
    held = docs.select(F.explode(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    ranked = held.where(F.col("w").rlike(r"^\p{L}+$")).orderBy(F.desc("n"), "w").limit(size)
    return [r["w"] for r in ranked.collect()]


class _Words(dict):
    """Token -> its word's hash, odd for common words; 0 for a token without a word."""

    def __init__(self, common: list[str] | tuple[str, ...] = ()):
        super().__init__()
        self.common = frozenset(common)

    def __missing__(self, token: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        word = token.strip(EDGES)
        code = 0
        if word:
            code = (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 3) ^ (2 if word in self.common else 3)
            code = code or 4
        self[token] = code
        return code


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    """One 32-bit hash per row of equally long arrays."""
    out = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        out = (out ^ p) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return (out >> np.uint64(32)).astype(np.uint32)


def anchors(codes: np.ndarray) -> np.ndarray:
    """Which words are anchors: all common ones, and of each ``GAP`` words without one the last with the least hash."""
    common = (codes & np.uint64(1)).astype(bool)
    if not len(codes):
        return common
    width = min(GAP, len(codes))
    windows = np.lib.stride_tricks.sliding_window_view(codes, width)
    bare = ~np.lib.stride_tricks.sliding_window_view(common, width).any(axis=1)
    least = width - 1 - windows[bare][:, ::-1].argmin(axis=1)
    common[np.flatnonzero(bare) + least] = True
    return common


def spot_signatures(text: str, words: _Words) -> np.ndarray:
    """The sorted distinct signature hashes of a text."""
    tokens = text.lower().split()
    codes = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    codes = codes[codes != 0]
    common = (codes & np.uint64(1)).astype(bool)
    content = np.concatenate([codes[~common], np.zeros(CHAIN, dtype=np.uint64)])
    # The place of each anchor's chain among the content words.
    at = np.cumsum(~common)[anchor] if (anchor := anchors(codes)).any() else np.zeros(0, dtype=np.int64)
    return np.unique(_mixed([codes[anchor], *(content[at + k] for k in range(CHAIN))]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """The Jaccard similarity of two sorted sets, or None as soon as it can't reach ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return None
    needed = least * (len(a) + len(b)) / (1 + least)
    both, block = 0, 64
    for at in range(0, len(a), block):
        part = a[at : at + block]
        both += int(np.isin(part, b, assume_unique=True).sum())
        if both + len(a) - at - len(part) < needed - 1e-9:
            return None
    got = both / (len(a) + len(b) - both) if len(a) else 1.0
    return got if got >= least else None


def _hex(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def _ranges(docs: DataFrame) -> list[int]:
    """First doc_ids of the ranges but the first; at most MAX_RANGES, however many rows."""
    n = docs.where(F.col("doc_id").isNotNull()).count()
    parts = min(MAX_RANGES, n // RANGE_ROWS)
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    marks = docs.agg(F.percentile_approx("doc_id", shares, 20 * parts)).first()[0]
    return sorted(set(marks))


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(part, doc_id, text, ahead)`` dealt by part; ``ahead`` marks copies that only end a range."""
    ids = docs.select("doc_id")
    marks = F.array(*[F.lit(m).cast("long") for m in _ranges(ids)]).cast("array<long>")
    part = F.coalesce(F.size(F.filter(marks, lambda m: m <= F.col("doc_id"))), F.lit(0))
    # One row per range comes to the driver: its first id.
    firsts = ids.groupBy(part.alias("part")).agg(F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("first")).orderBy("part").collect()
    heads = [(r["part"], None if r["nulls"] else r["first"]) for r in firsts]
    before = {head: (heads[i - 1][0] if i else heads[-1][0]) for i, (_, head) in enumerate(heads)}
    own = docs.select(part.alias("part"), "doc_id", "text", F.lit(False).alias("ahead"))
    known = {h: p for h, p in before.items() if h is not None}
    to = F.lit(None).cast("int")
    if known:
        pairs = F.create_map(*[F.lit(x) for h, p in known.items() for x in (h, p)])
        to = F.try_element_at(pairs, F.col("doc_id"))
    if None in before:
        to = F.when(F.col("doc_id").isNull(), F.lit(before[None])).otherwise(to)
    ahead = docs.where(to.isNotNull()).select(to.alias("part"), "doc_id", "text", F.lit(True).alias("ahead"))
    return own.unionByName(ahead), max(1, len(heads))


def document_fingerprints(docs: DataFrame, common: list[str] | None = None) -> DataFrame:
    """The digest per row of ``docs``; ``common`` are the corpus's common words, counted if not given."""
    common = common_words(docs) if common is None else common
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    placed, parts = with_next(texts)

    def fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words(common)
        held = None  # (part, doc_id, text, signatures) that waits for its next

        def row(held, text, own):
            _, doc_id, mine, signatures = held
            half = len(mine) // 2
            edited = mine[: len(mine) - half] + text[:half]
            other = spot_signatures(edited, words)
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return (doc_id, len(mine), sha, _hex(signatures), _hex(other), likeness(signatures, other), likeness(signatures, own), len(signatures))

        for batch in batches:
            out = []
            ids = batch["doc_id"].astype("Int64").to_list()
            for part, doc_id, text, ahead in zip(batch["part"], ids, batch["text"], batch["ahead"]):
                own = spot_signatures(text, words) if held is not None or not ahead else None
                if held is not None and held[0] == part:
                    out.append(row(held, text, own))
                # A copy only completes the range's last document.
                held = None if ahead else (part, None if doc_id is pd.NA else doc_id, text, own)
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in DIGEST.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    dealt = placed.repartition(parts, "part").sortWithinPartitions("part", "ahead", F.asc_nulls_first("doc_id"), "text")
    return dealt.mapInPandas(fingerprints, DIGEST)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, common: list[str] | None = None) -> DataFrame:
    """``(fingerprint_a, fingerprint_b, jaccard)`` of all different fingerprints that alike, and no others.

    ``docs`` has ``(doc_id, text)``; equal fingerprints are one.  Join with
    the fingerprints of documents for members.
    """
    common = common_words(docs) if common is None else common

    @F.pandas_udf("array<long>")
    def signatures(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _Words(common)
        for batch in texts:
            yield pd.Series([spot_signatures(t, words).astype(np.int64) for t in batch])

    @F.pandas_udf("double")
    def compared(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([pruned_jaccard(np.asarray(a), np.asarray(b), threshold) for a, b in zip(x, y)], dtype="float64")

    sets = cut(docs.select(signatures(text_of(F.col("text"))).alias("s")).distinct().where(F.size("s") > 0), "spot-sets")
    n = F.size("s")
    # Partition k holds lengths in [threshold^-k, threshold^-(k+1)): a set can
    # match sets of its own partition and of the next.
    k = F.floor(F.log(n) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    prefix = F.slice("s", 1, n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1)
    own = sets.select("s", k.alias("k"), F.explode(prefix).alias("token"))
    upper = own.select(F.col("s").alias("b"), "k", "token")
    lower = own.select(F.col("s").alias("a"), F.explode(F.array(F.col("k"), F.col("k") + 1)).alias("k"), "token")
    shorter = (F.size("a") < F.size("b")) | ((F.size("a") == F.size("b")) & (F.col("a") < F.col("b")))
    pairs = lower.join(upper, ["k", "token"]).where(shorter & (F.size("a") >= threshold * F.size("b") - 1e-9)).select("a", "b").distinct()
    found = pairs.withColumn("jaccard", compared("a", "b")).where("jaccard is not null")
    return found.select(*[F.array_join(F.transform(c, lambda v: F.lower(F.lpad(F.hex(v), 8, "0"))), "").alias(f"fingerprint_{c}") for c in "ab"], "jaccard")
