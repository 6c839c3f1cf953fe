"""Operator 5: sampled SentencePiece segmentation and lossless decoding.

The vocabulary of a SentencePiece model spans a lattice over each text: an
edge for every piece that covers a stretch of characters, and byte pieces for
characters that no piece covers.  A piece's weight follows its rank
(probability in proportion to 1 / rank, to the power ``alpha``).  Forward
filtering sums the weights of all paths to each place, backward sampling then
draws a segmentation from the exact distribution over paths.

Paths never cross the start of a run of spaces or a newline, so the lattice
falls apart into one small lattice per word; words of a block of texts are
filtered once per different word, and all their occurrences are sampled in
step.  Every draw is a hash of (seed, row key, place in the text): a row's
segmentation depends on nothing else, not on batches, partitions or retries.
Rows with the same key and text get the same segmentation.

Decoding joins the pieces' bytes.  A space is the model's own mark; a mark
that stands in the text itself goes through byte pieces, so decoding gives
back every text exactly.

Nulls and empties: a null or empty text has no pieces and decodes to the
empty text; a null key is a key of its own; an empty table gives an empty
result; very long words are one lattice.  Memory is bounded by a block of
``BLOCK_CHARS`` characters, or one text where that is longer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
WORD = re.compile(r" *[^ \n]+| +|\n")
BLOCK_CHARS = 300_000
#: Bytes of text after which a result is handed back to Spark.
RESULT_BYTES = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SIEVE_BITS = 18
SIEVE_SHIFT = np.uint64(64 - SIEVE_BITS)
#: Stands for a mark in the text itself: no piece holds it.
FOREIGN = 0x110000


@dataclass
class Vocabulary:
    """Pieces by id, as text (None for control and byte pieces), with ranks from 1."""

    pieces: list[str | None]
    ranks: list[int]
    byte_ids: list[int]

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
        order = sorted((i for i in range(n) if plain[i]), key=lambda i: (-model.get_score(i), i))
        ranks = [0] * n
        for rank, i in enumerate(order, 1):
            ranks[i] = rank
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return cls([model.id_to_piece(i) if plain[i] else None for i in range(n)], ranks, byte_ids)

    def bytes_of(self) -> list[bytes]:
        """What each id adds to the decoded text."""
        table = [b"" if p is None else p.replace(MARK, " ").encode("utf-8") for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            table[i] = bytes([b])
        return table


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number strictly between 0 and 1 for each (seed, place)."""
    x = seed + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.clip((x >> np.uint64(11)).astype(np.float64) * 2.0**-53, 1e-9, 1 - 1e-9)


class Lattice:
    """Piece lookup by length, and the filtered lattices of a list of words."""

    def __init__(self, vocabulary: Vocabulary, alpha: float):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.weight = -alpha * np.log(np.maximum(1, np.array(vocabulary.ranks, dtype=np.float64)))
        self.byte_weight = -alpha * np.log(len(vocabulary.pieces))
        lengths: dict[int, list[tuple[int, int]]] = {}
        for i, piece in enumerate(vocabulary.pieces):
            if piece:
                h = 0
                for c in piece:
                    h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                lengths.setdefault(len(piece), []).append((h, i))
        for n, found in lengths.items():
            found.sort()
            known = np.array([h for h, _ in found], dtype=np.uint64)
            # Most strings are no piece: a small table tells so at once.
            maybe = np.zeros(1 << SIEVE_BITS, dtype=bool)
            maybe[known >> SIEVE_SHIFT] = True
            self.by_length[n] = (known, np.array([i for _, i in found], dtype=np.int64), maybe)
        self.longest = max(self.by_length, default=1)

    def filtered(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Edges into each place with their running probabilities.

        Word w's places are ``first[w] .. first[w] + len(word)``.  Returns
        (first, group of each place, group starts, running probability plus
        group, edge source, edge code).  Codes are piece ids, or -1 - c for
        the bytes of character c.
        """
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = _points("".join(words))
        points = np.where(raw == ord(MARK), FOREIGN, np.where(raw == 32, ord(MARK), raw)).astype(np.uint64) + np.uint64(1)
        word = np.repeat(np.arange(len(words)), lens)
        ends = np.cumsum(lens)
        first = ends - lens + np.arange(len(words))
        at = np.arange(len(raw))
        left = ends[word] - at
        hashes = np.zeros(len(raw), dtype=np.uint64)
        sources, sizes, codes, weights = [], [], [], []
        for n in range(1, self.longest + 1):
            hashes = hashes * BASE + points[at + n - 1]
            if n in self.by_length:
                known, ids, maybe = self.by_length[n]
                tried = np.flatnonzero(maybe[hashes >> SIEVE_SHIFT])
                place = np.minimum(np.searchsorted(known, hashes[tried]), len(known) - 1)
                hit = known[place] == hashes[tried]
                start, piece = at[tried[hit]], ids[place[hit]]
                sources.append(start)
                sizes.append(np.full(len(start), n))
                codes.append(piece)
                weights.append(self.weight[piece])
                if n == 1:
                    rest = np.ones(len(at), dtype=bool)
                    rest[tried[hit]] = False
                    start = at[rest]
                    sources.append(start)
                    sizes.append(np.full(len(start), 1))
                    codes.append(-1 - raw[start].astype(np.int64))
                    size = 1 + (raw[start] >= 0x80) + (raw[start] >= 0x800).astype(np.int64) + (raw[start] >= 0x10000)
                    weights.append(size * self.byte_weight)
            on = left > n
            at, left, hashes = at[on], left[on], hashes[on]
            if not len(at):
                break
        # Longer pieces first: they are the likelier ones of a place.
        source, size, code, weight = (np.concatenate(x[::-1]) for x in (sources, sizes, codes, weights))
        owner = word[source]
        source = source + owner
        target = source + size
        offset = target - first[owner]
        order = np.lexsort((target, offset))
        source, target, code, weight, offset = source[order], target[order], code[order], weight[order], offset[order]
        total = np.zeros(len(raw) + len(words))
        running = np.empty(len(source))
        new = np.empty(len(source), dtype=bool)
        new[0] = True
        np.not_equal(target[1:], target[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        cuts = np.searchsorted(offset, np.arange(1, int(offset[-1]) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            ga, gb = group[a], group[b - 1] + 1
            heads, own = starts[ga:gb] - a, group[a:b] - ga
            value = total[source[a:b]] + weight[a:b]
            top = np.maximum.reduceat(value, heads)
            share = np.exp(value - top[own])
            mass = np.add.reduceat(share, heads)
            total[target[a:b][heads]] = top + np.log(mass)
            share /= mass[own]
            whole = np.cumsum(share)
            before = np.where(heads > 0, whole[heads - 1], 0.0)
            running[a:b] = ga + own + np.minimum(whole - before[own], 1.0)
        group_of = np.full(len(raw) + len(words), -1, dtype=np.int64)
        group_of[target] = group
        return first, group_of, np.append(starts, len(source)), running, source, code


class Sampler:
    """Sampled segmentations of texts."""

    def __init__(self, vocabulary: Vocabulary, alpha: float, seed: int):
        self.lattice = Lattice(vocabulary, alpha)
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int64)
        self.table = vocabulary.bytes_of()
        self.seed = seed

    def encode(self, keys: list[str], texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, in blocks of bounded size."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= BLOCK_CHARS):
                chars += len(texts[end])
                end += 1
            out += self._block(keys[at:end], texts[at:end])
            at = end
        return out

    def _block(self, keys: list[str], texts: list[str]) -> list[np.ndarray]:
        # As in the model, a text starts with a space.
        split = [WORD.findall(f" {t}") if t else [] for t in texts]
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        words = [w for ws in split for w in ws]
        if not words:
            return [np.empty(0, dtype=np.int32)] * len(texts)
        kinds = {w: i for i, w in enumerate(dict.fromkeys(words))}
        kind = np.fromiter(map(kinds.__getitem__, words), dtype=np.int64, count=len(words))
        lens = np.fromiter(map(len, kinds), dtype=np.int64, count=len(kinds))
        first, group_of, starts, running, source, code = self.lattice.filtered(list(kinds))
        doc = np.repeat(np.arange(len(texts)), counts)
        past = np.cumsum(lens[kind]) - lens[kind]
        begin = past - past[np.searchsorted(doc, doc)]
        seeds = np.array([xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), self.seed) for k in keys], dtype=np.uint64)[doc]
        base = first[kind]
        place = base + lens[kind]
        live = np.arange(len(words))
        steps = []
        while len(live):
            here = place[live]
            group = group_of[here]
            draw = _uniform(seeds[live], begin[live] + here - base[live])
            edge, last, mark = starts[group], starts[group + 1] - 1, group + draw
            behind = np.flatnonzero((running[edge] < mark) & (edge < last))
            while len(behind):
                edge[behind] += 1
                behind = behind[(running[edge[behind]] < mark[behind]) & (edge[behind] < last[behind])]
            steps.append((live, code[edge]))
            place[live] = source[edge]
            live = live[place[live] > base[live]]
        return self._in_order(steps, doc, len(words), len(texts))

    def _in_order(self, steps, doc: np.ndarray, words: int, texts: int) -> list[np.ndarray]:
        """Pieces were drawn from each word's end: turn them round and cut them by text."""
        size = np.zeros(words, dtype=np.int64)
        for live, _ in steps:
            size[live] += 1
        ends = np.cumsum(size)
        ids = np.empty(int(ends[-1]), dtype=np.int64)
        for k, (live, codes) in enumerate(steps):
            ids[ends[live] - 1 - k] = codes
        bounds = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(texts + 1))]
        cuts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return [self._with_bytes(x).astype(np.int32) for x in cuts]

    def _with_bytes(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids) or ids.min() >= 0:
            return ids
        foreign = np.flatnonzero(ids < 0)
        raw = [self.byte_ids[list(chr(-1 - int(c)).encode("utf-8", "surrogatepass"))] for c in ids[foreign]]
        width = np.ones(len(ids), dtype=np.int64)
        width[foreign] = [len(x) for x in raw]
        out = np.repeat(ids, width)
        out[np.repeat(ids < 0, width)] = np.concatenate(raw)
        return out


def decode_ids(ids, table: list[bytes]) -> str:
    """The text of a list of ids; the first space is the model's own."""
    return b"".join([table[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


def encode_udf(vocabulary: Vocabulary, alpha: float, seed: int):
    """``(key, text) -> struct(ids, lossless)``; lossless tells that the ids decode to the text."""

    @F.pandas_udf("ids array<int>, lossless boolean")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(vocabulary, alpha, seed)
        for keys, texts in batches:
            texts = ["" if t is None else t for t in texts]
            ids = sampler.encode(["" if k is None else f"={k}" for k in keys], texts)
            same = [decode_ids(x.tolist(), sampler.table) == t for x, t in zip(ids, texts)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "lossless": same})

    return encode


def encode(df: DataFrame, key: Column, text: Column, model: str = MODEL, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``df`` with struct column ``pieces`` of ``ids`` and ``lossless``."""
    of = encode_udf(Vocabulary.load(model), alpha, seed)
    return df.withColumn("pieces", of(key.cast("string"), text.cast("string")))


def decode(df: DataFrame, ids: Column, model: str = MODEL) -> DataFrame:
    """``df`` with column ``decoded``: the text of its ids (null and empty: empty)."""
    table = Vocabulary.load(model).bytes_of()

    @F.pandas_udf("string")
    def decoded(lists: pd.Series) -> pd.Series:
        return pd.Series([decode_ids([] if x is None else x, table) for x in lists], dtype=object)

    return df.withColumn("decoded", decoded(ids))


def piece_digest(docs: DataFrame, model: str = MODEL, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``(doc_id, ids, n_ids, lossless)`` per row of ``docs``.

    Results leave the worker in small parts, however many rows or bytes Spark
    hands over at once.
    """
    vocabulary = Vocabulary.load(model)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary, alpha, seed)
        for batch in batches:
            size = np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()])
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(size, size[at] + RESULT_BYTES, side="right")) - 1)
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column(2).to_pylist()]
                keys = ["" if k is None else f"={k}" for k in part.column(1).to_pylist()]
                ids = sampler.encode(keys, texts)
                same = [decode_ids(x.tolist(), sampler.table) == t for x, t in zip(ids, texts)]
                counts = [len(x) for x in ids]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(counts, pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_ids", "lossless"]
                )
                at = end

    rows = docs.select("doc_id", F.col("doc_id").cast("string").alias("key"), F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(segment, f"doc_id {kind}, ids array<int>, n_ids bigint, lossless boolean")
