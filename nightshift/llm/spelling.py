"""Operator 11: spelling variants by dense prefix-suffix tiling.

Words are near when one inserted, deleted or replaced code point turns one
into the other: then their common prefix and suffix together reach the longer
length minus one.

1. Words and their counts come from all texts (``word_counts``).
2. A pair differs in one place, and that place lies in one of ``SEGMENTS`` equal
   segments of the longer word; the rest of both words is the same.  So each
   word goes to one bucket for each segment, by longer length, segment, and
   the hash of what stands before and behind it; once as the longer (or
   equally long) word and once as the shorter one.
3. A bucket is compared as a dense tile: the words are rows of two padded
   code-point matrices, one aligned left, one right, and every row is
   compared with the rows 1, 2, 3, ... below it in the same bucket, all
   buckets of a block at once.  The first unequal column tells the common
   prefix, the last one the common suffix.  A pair counts in the bucket of
   the segment in which its prefix ends, so it is found exactly once and no
   pairs are shuffled or made distinct: a tile hands on, for each word, the
   number of its near words and the best of them.
4. A bucket of more than ``TILE`` words (fewer where words are very long) is cut
   into parts by a hash of the word, and each pair of parts is a tile of its
   own, so a large bucket is many tasks' work and a tile holds about two parts.
5. A word's form is its best near word if that is frequent enough; roots
   follow forms by pointer doubling (counts grow tenfold at each step, so the
   rounds are few).

Nulls and empties: null and empty texts hold no words; null ids make null
hashes, so their words are taken as they stand; rows that repeat are counted
each; ties of counts go to the smallest word in code-point order; no words
give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut, lower_ascii

LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is at least so many times as frequent.
RATIO = 10
#: Typing slips that the query plants: every so many-th hash loses a code point.
SLIP = 31
SEGMENTS = 3
TILE = 2048
#: Cells of a matrix, and pairs that a task compares at once.
CELLS = 4_000_000
PAIRS = 400_000
TILE_KEYS = ["length", "segment", "key", "a", "b"]
FOUND = "word string, n_near long, near string, near_n long"


def runs(text: Column, least: int) -> Column:
    """The maximal runs of letters of at least ``least`` code points, as they stand.

    A match begins at the first place that can hold one, so it never begins
    within a longer run, and it is greedy.
    """
    return F.regexp_extract_all(text, F.lit(LETTERS + "{" + str(least) + ",}"), F.lit(0))


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``(word, n)`` of all texts, with the slips that the query states."""
    found = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(runs(F.col("text").cast("string"), min_length)).alias("run"))
    # ``lower`` has a fast path for ASCII, where it changes A-Z alone.
    plain = F.octet_length("run") == F.char_length("run")
    low = found.select("id", F.when(plain, F.lower("run")).otherwise(lower_ascii(F.col("run"))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    each = low.select("run", h.alias("h"))
    at = F.pmod(F.col("h"), F.char_length("run").cast("long")).cast("int")
    cut_run = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.pmod(F.col("h"), F.lit(slip)) == 0, cut_run).otherwise(F.col("run"))
    words = each.select(word.alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _bounds(length: Column, k: int) -> Column:
    """Where segment ``k`` of a word of ``length`` begins."""
    return F.floor(length * k / SEGMENTS).cast("int")


def bucketed(words: DataFrame) -> DataFrame:
    """``(length, segment, key, word, n)``: each word in the buckets of the segments that may hold an edit.

    ``length`` is that of the longer word of a bucket's pairs.
    """
    own = F.char_length("word")
    places = F.array(*[
        F.struct((own + shorter).alias("length"), F.lit(k).alias("segment"), _bounds(own + shorter, k).alias("before"),
                 (own + shorter - _bounds(own + shorter, k + 1)).alias("behind"))
        for shorter in (0, 1) for k in range(SEGMENTS)
    ])
    dealt = words.select("word", "n", F.inline(places))
    behind = F.substring("word", own - F.col("behind") + 1, F.col("behind"))
    key = F.xxhash64("length", "segment", F.substring("word", F.lit(1), F.col("before")), behind)
    return dealt.select("length", "segment", key.alias("key"), "word", "n")


def tiles(buckets: DataFrame, tile: int = TILE) -> DataFrame:
    """The buckets with ``(a, b, part)``: the pair of parts that a tile compares, and the row's own part."""
    most = F.greatest(F.lit(2), F.least(F.lit(tile), F.floor(F.lit(CELLS) / F.col("length"))))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(most).alias("most")).where("size > most")
    large = cut(sizes.select("key", F.ceil(F.col("size") / F.col("most")).cast("int").alias("parts")), "spelling-large")
    held = buckets.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    held = held.withColumn("part", F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts").cast("long")).cast("int"))
    other = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return other.select("length", "segment", "key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "word", "n")


class _Tile:
    """Sorted rows of whole buckets of one length: words as Latin-1 code points, compared row by row below."""

    def __init__(self, length: int, words: list[bytes], tile: np.ndarray, segment: np.ndarray, cross: np.ndarray, part: np.ndarray):
        self.length, self.tile, self.cross, self.part = length, tile, cross, part
        n = len(words)
        self.size = np.fromiter(map(len, words), dtype=np.int64, count=n)
        self.left = np.frombuffer(b"".join(w.ljust(length, b"\0") for w in words), dtype=np.uint8).reshape(n, length)
        self.right = np.frombuffer(b"".join(w.rjust(length, b"\0") for w in words), dtype=np.uint8).reshape(n, length)
        bounds = np.array([length * k // SEGMENTS for k in range(SEGMENTS + 1)])
        self.begin, self.end = bounds[segment], bounds[segment + 1]

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs differ by one edit that begins in their segment."""
        differ = self.left[i] != self.left[j]
        prefix = differ.argmax(axis=1)
        here = (prefix >= self.begin[i]) & (prefix < self.end[i]) & differ.any(axis=1)
        out = np.zeros(len(i), dtype=bool)
        rest = np.flatnonzero(here)
        if len(rest):
            a, b = i[rest], j[rest]
            suffix = (self.right[a] != self.right[b])[:, ::-1].argmax(axis=1)
            out[rest] = prefix[rest] + suffix >= self.length - 1
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The near pairs of rows, each once."""
        rows = np.arange(len(self.tile))
        step = max(1, min(PAIRS, CELLS // max(1, self.length)))
        down = 1
        while len(rows):
            rows = rows[rows + down < len(self.tile)]
            rows = rows[self.tile[rows] == self.tile[rows + down]]
            # One of the two has the tile's length; tiles of two parts compare one with the other.
            full = (self.size[rows] == self.length) | (self.size[rows + down] == self.length)
            meant = rows[full & (~self.cross[rows] | (self.part[rows] != self.part[rows + down]))]
            for at in range(0, len(meant), step):
                i = meant[at : at + step]
                j = i + down
                hit = self.near(i, j)
                if hit.any():
                    yield i[hit], j[hit]
            down += 1


def _best(words: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    """For each row that occurs in the pairs: the number of near rows and the best one."""
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    found = pd.DataFrame({"word": words[a], "near": words[b], "near_n": n[b]})
    found = found.sort_values(["word", "near_n", "near"], ascending=[True, False, True], kind="stable")
    of = found.groupby("word", sort=False)
    out = of.first()
    out.insert(0, "n_near", of.size())
    return out.reset_index()[["word", "n_near", "near", "near_n"]]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut where a tile ends, so that no tile is parted."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        keys = batch[TILE_KEYS].to_numpy()
        if held and (held[-1][TILE_KEYS].to_numpy()[-1] != keys[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        # The batch's last tile may go on in the next one.
        before = np.flatnonzero((keys != keys[-1]).any(axis=1))
        if len(before):
            yield pd.concat([*held, batch.iloc[: before[-1] + 1]], ignore_index=True)
            held, batch = [], batch.iloc[before[-1] + 1 :]
        held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def _tiles(block: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """``(length, rows, tile number of each row)`` of a block, within ``CELLS`` or one tile; lone words are left out."""
    keys = block[TILE_KEYS].to_numpy()
    tile = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    many = np.bincount(tile)[tile] > 1
    block, tile = block[many], tile[many]
    lengths = block["length"].to_numpy()
    at = 0
    while at < len(block):
        length = int(lengths[at])
        end = min(int(np.searchsorted(lengths, length, side="right")), at + max(2, CELLS // length))
        if end < len(block) and tile[end - 1] == tile[end]:
            # Not within a tile: before it, or behind it where it is the first.
            begun = int(np.searchsorted(tile, tile[end]))
            end = begun if begun > at else int(np.searchsorted(tile, tile[end], side="right"))
        yield length, block.iloc[at:end], tile[at:end]
        at = end


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for block in _blocks(b for b in batches if len(b)):
        for length, rows, tile in _tiles(block):
            words = rows["word"].to_numpy()
            made = _Tile(length, [w.encode("latin-1") for w in words], tile, rows["segment"].to_numpy(),
                         (rows["a"] != rows["b"]).to_numpy(), rows["part"].to_numpy())
            found = list(made.pairs())
            if found:
                yield _best(words, rows["n"].to_numpy(), np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``(word, n_near, near, near_n)`` of the words that have near words: their number and the most frequent one."""
    dealt = tiles(bucketed(words), tile).repartition("key", "a", "b")
    sorted_rows = dealt.sortWithinPartitions(*TILE_KEYS)
    parts = sorted_rows.mapInPandas(_compare, FOUND)
    first = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return best.select("word", "n_near", F.col("first.near").alias("near"), (-F.col("first.order")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last word that is reached from ``(word, form)`` by following forms."""
    at = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("__at"), F.col("root").alias("__on"))
        moved = at.join(onward, F.col("root") == F.col("__at"), "left")
        moved = cut(moved.select("word", F.coalesce("__on", "root").alias("root"), F.col("__on").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per word; see the module docstring."""
    words = cut(word_counts(docs), "spelling-words")
    near = cut(near_words(words, tile), "spelling-near")
    frequent = F.col("near_n") >= RATIO * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", F.when(frequent, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    formed = cut(formed, "spelling-formed")
    known = roots(formed.where("form IS NOT NULL"))
    return formed.join(known, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
