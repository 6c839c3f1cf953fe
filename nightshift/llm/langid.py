"""Operator 13: language identification by a linear-chain conditional random field.

The field labels every word of a text with a language, so that code-switched
text is told apart; a document's language is the one with the largest sum of
word marginals.

* Features of a word (``WordFeatures``): its character n-grams up to three, its
  affixes up to four letters (n-grams with the word's edge), all hashed, and
  itself if it is in the lexicon of the labelled rows' most frequent words.
* Transitions between the languages of neighbouring words, and from a text's
  beginning, are learned with the feature weights by maximising the
  likelihood.  Labelled documents are of one language each; for the transitions
  they are cut into spans that are shuffled and strung together, so a
  sequence switches languages as code-switched text does.
* The likelihood is maximised in ``ROUNDS`` rounds of parameter mixing: each of
  ``SHARDS`` parts of the labelled rows runs gradient steps (Adagrad) from the
  common weights in a task of its own, and the parts' weights are averaged.
* Marginals come from forward-backward.  A text is cut into segments of ``SEGMENT``
  words; a first pass gives each segment's transfer matrix, the segments of
  a text pass vectors on to each other, and a second pass gives the marginals.
  That is exact, and a very long text is as many rows as it has segments, so
  all texts of a block advance together, one word a step.

``max_labelled`` bounds the labelled rows that are learned from (a hash sample for
each language when there are more; copies of a text count once), and
``MAX_LANGUAGES`` the languages, the most frequent ones.  Every whole text is
labelled.

Nulls and empties: a null text or one without a letter is ``und`` with score 0;
rows with null lang or id aren't learned from; with one learned language
every text with a letter gets it (score 1); with none every text is ``und``;
ties go to the smallest language; rows that repeat are all returned; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut

MAX_LABELLED = 2_400
MAX_LANGUAGES = 64
LEXICON = 6_000
BITS = 15
SHARDS, ROUNDS = 4, 4
#: Words of a training sequence, of the spans in it, and sequences of a gradient step.
LENGTH, SPAN, BATCH = 64, (4, 60), 48
RATE, DECAY = 0.3, 1e-4
SEGMENT = 128
BLOCK_CHARS = 6_000_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
PREDICTED = "doc_id long, lang_pred string, score double"
LABELLED = "doc_id long, words array<struct<begin:int,end:int,lang:string,score:double>>"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


class WordFeatures:
    """Feature numbers of words; hashed n-grams first, then one for each word of the lexicon."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = {w: (1 << BITS) + i for i, w in enumerate(lexicon)}
        self.size = (1 << BITS) + len(lexicon)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(word number, feature)`` pairs, sorted by word."""
        points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
        of = np.repeat(np.arange(len(words)), sizes)
        last = np.cumsum(sizes) - 1
        first = last - sizes + 1
        edge = np.zeros(len(points), dtype=bool)
        edge[first] = edge[last] = True
        numbers, features = [], []
        h = np.zeros(len(points), dtype=np.uint64)
        for n in range(1, 6):
            h = h[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
            at = np.arange(len(h))
            here = of[at] == of[at + n - 1]
            if n == 1:
                here &= ~edge
            elif n > 3:
                here &= edge[at] | edge[at + n - 1]
            at = at[here]
            mixed = h[at] * np.uint64(0x9E3779B97F4A7C15)
            numbers.append(of[at])
            features.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
        known = [(i, self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        numbers.append(np.array([i for i, _ in known], dtype=np.int64))
        features.append(np.array([f for _, f in known], dtype=np.int64))
        word, feature = np.concatenate(numbers), np.concatenate(features)
        order = np.argsort(word, kind="stable")
        return word[order], feature[order]


@dataclass
class Field:
    """The field's weights: features by language, and transitions (the last row begins a text)."""

    languages: list[str]
    lexicon: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def scores(self, word: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """The words' log potentials, ``(n, languages)``."""
        count = np.maximum(1, np.bincount(word, minlength=n))
        sums = [np.bincount(word, weights=self.weights[feature, k], minlength=n) for k in range(len(self.languages))]
        return np.stack(sums, axis=1) / np.sqrt(count)[:, None]

    def potentials(self, scores: np.ndarray) -> np.ndarray:
        return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30.0))


def _scaled(x: np.ndarray, axis=-1) -> np.ndarray:
    return x / x.sum(axis=axis, keepdims=True)


def marginals(potentials: np.ndarray, words: np.ndarray, sizes: np.ndarray, moves: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """The marginals of every word of texts that stand one behind the other.

    ``words`` are rows of ``potentials``, ``sizes`` the texts' word counts (each at least 1).
    """
    k = potentials.shape[1]
    step = np.exp(moves - moves.max())
    begin = np.cumsum(sizes) - sizes
    pieces = -(-sizes // segment)
    text = np.repeat(np.arange(len(sizes)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = begin[text] + nth * segment
    size = np.minimum(segment, sizes[text] - nth * segment)
    # Long segments first: those that have a word left are always the first ones.
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    left = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size[0]) + 1)] if len(size) else []
    live = [int(np.count_nonzero(size > t)) for t in range(len(left) - 1)]

    def at(t: int) -> np.ndarray:
        return potentials[words[start[: live[t]] + t]]

    # Each segment's transfer from the state before it to its last state.
    transfer = step[None] * at(0)[:, None, :]
    for t in range(1, len(live)):
        m = live[t]
        transfer[:m] = (transfer[:m].reshape(-1, k) @ step[:k]).reshape(m, k + 1, k) * at(t)[:, None, :]
        transfer[:m] /= transfer[:m].sum(axis=(1, 2), keepdims=True)
    # Vectors from segment to segment, all texts at once.
    into = np.zeros((len(start), k + 1))
    behind = np.ones((len(start), k))
    most = int(pieces.max())
    offsets = np.cumsum(pieces) - pieces
    vector = np.zeros((len(sizes), k + 1))
    vector[:, k] = 1.0
    for j in range(most):
        on = np.flatnonzero(pieces > j)
        seg = place[offsets[on] + j]
        into[seg] = vector[on]
        vector[on, :k] = _scaled(np.einsum("si,sik->sk", vector[on], transfer[seg]))
        vector[on, k] = 0.0
    back = np.ones((len(sizes), k))
    for j in range(most - 1, -1, -1):
        on = np.flatnonzero(pieces > j)
        seg = place[offsets[on] + j]
        behind[seg] = back[on]
        back[on] = _scaled(np.einsum("sik,sk->si", transfer[seg], back[on])[:, :k])
    # The marginals within the segments.
    out = np.empty((len(words), k), dtype=np.float32)
    forward = _scaled((into @ step) * at(0))
    out[start] = forward
    for t in range(1, len(live)):
        m = live[t]
        forward = _scaled((forward[:m] @ step[:k]) * at(t))
        out[start[:m] + t] = forward
    backward = behind
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        rows = start[:m] + t
        both = out[rows] * backward[:m]
        out[rows] = _scaled(both)
        if t:
            backward[:m] = _scaled((at(t) * backward[:m]) @ step[:k].T)
    return out


# -- learning ------------------------------------------------------------------
def _sequences(texts: list[np.ndarray], labels: list[int], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Code-switched sequences of ``LENGTH`` words: the texts' spans, shuffled."""
    spans = []
    for words, label in zip(texts, labels):
        at = 0
        while at < len(words):
            end = at + int(rng.integers(*SPAN))
            spans.append((words[at:end], label))
            at = end
    order = rng.permutation(len(spans))
    words = np.concatenate([spans[i][0] for i in order])
    label = np.concatenate([np.full(len(spans[i][0]), spans[i][1]) for i in order])
    # The last sequence begins again with the first words.
    n = -(-len(words) // LENGTH) * LENGTH
    return np.resize(words, n).reshape(-1, LENGTH), np.resize(label, n).reshape(-1, LENGTH)


def _gradient(field: Field, potentials: np.ndarray, words: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a step's log likelihood: by word occurrence ``(n, LENGTH, languages)``, and by transition."""
    k = len(field.languages)
    step = np.exp(field.moves - field.moves.max())
    n, length = words.shape
    e = potentials[words]
    forward = np.empty((length, n, k))
    forward[0] = _scaled(step[k] * e[:, 0])
    for t in range(1, length):
        forward[t] = _scaled((forward[t - 1] @ step[:k]) * e[:, t])
    by_word = np.empty((n, length, k))
    by_move = np.zeros((k + 1, k))
    backward = np.ones((n, k))
    for t in range(length - 1, -1, -1):
        by_word[:, t] = -_scaled(forward[t] * backward)
        ahead = e[:, t] * backward
        if t:
            both = forward[t - 1][:, :, None] * step[None, :k] * ahead[:, None, :]
            by_move[:k] -= (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            backward = _scaled(ahead @ step[:k].T)
    by_move[k] += by_word[:, 0].sum(axis=0)
    rows, cols = np.indices(words.shape)
    by_word[rows, cols, labels] += 1.0
    np.add.at(by_move, (labels[:, :-1], labels[:, 1:]), 1.0)
    np.add.at(by_move, (np.full(n, k), labels[:, 0]), 1.0)
    return by_word, by_move


def improved(field: Field, texts: list[list[str]], labels: list[int], seed: int) -> tuple[Field, int]:
    """The field after one pass over ``texts``, and the number of their words."""
    words = [w for t in texts for w in t]
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    word, feature = WordFeatures(field.lexicon)(list(distinct))
    offsets = np.r_[0, np.cumsum(np.bincount(word, minlength=len(distinct)))]
    ends = np.cumsum([len(t) for t in texts])
    rng = np.random.default_rng(seed)
    sequences, wanted = _sequences(np.split(codes, ends[:-1]), labels, rng)
    weights, moves = field.weights.copy(), field.moves.copy()
    now = Field(field.languages, field.lexicon, weights, moves)
    seen_w, seen_m = np.full(weights.shape, 1e-3), np.full(moves.shape, 1e-3)
    for at in range(0, len(sequences), BATCH):
        rows, want = sequences[at : at + BATCH], wanted[at : at + BATCH]
        used, inverse = np.unique(rows, return_inverse=True)
        inverse = inverse.reshape(rows.shape)
        count = offsets[used + 1] - offsets[used]
        pick = np.repeat(offsets[used] - np.cumsum(count) + count, count) + np.arange(count.sum())
        own, of = np.repeat(np.arange(len(used)), count), feature[pick]
        by_word, by_move = _gradient(now, now.potentials(now.scores(own, of, len(used))), inverse, want)
        size = rows.size
        root = np.sqrt(np.maximum(1, count))[own]
        for k in range(len(field.languages)):
            g = np.bincount(inverse.ravel(), weights=by_word[:, :, k].ravel(), minlength=len(used))
            g = np.bincount(of, weights=g[own] / root, minlength=len(weights)) / size - DECAY * weights[:, k]
            seen_w[:, k] += g * g
            weights[:, k] += RATE * g / np.sqrt(seen_w[:, k])
        g = by_move / size
        seen_m += g * g
        moves += RATE * g / np.sqrt(seen_m)
    return now, len(words)


def labelled_sample(docs: DataFrame, bound: int) -> tuple[DataFrame, list[str]]:
    """``(text, lang, shard)`` of at most about ``bound`` labelled rows that are not held out, and their languages."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    step, million = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)), 1_000_000
    chosen = F.lit(False)
    for r in sizes:
        share = min(million, int(million * bound / len(sizes) / r["count"]) + 1)
        chosen = chosen | ((F.col("lang") == r["lang"]) & (step < share))
    shard = F.pmod(F.xxhash64("text"), F.lit(SHARDS)).cast("int").alias("shard")
    rows = known.where(chosen).dropDuplicates(["text", "lang"]).select("text", "lang", shard)
    return cut(rows, "langid-labelled"), sorted(r["lang"] for r in sizes)


def frequent_words(rows: DataFrame, size: int) -> list[str]:
    """The ``size`` words that most of the rows hold."""
    words = rows.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).where("w <> ''")
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    return [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(size).collect()]


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _one_pass(field: Field, nth: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "text"])
        rows = [(words_of(t), field.languages.index(x)) for t, x in zip(group["text"], group["lang"])]
        rows = [r for r in rows if r[0]]
        if not rows:
            return pd.DataFrame({"n": [], "weights": [], "moves": []})
        now, n = improved(field, [t for t, _ in rows], [x for _, x in rows], 100 * nth + int(group["shard"].iloc[0]))
        return pd.DataFrame({"n": [n], "weights": [now.weights.astype(np.float32).tobytes()], "moves": [now.moves.tobytes()]})

    return run


def fit_field(docs: DataFrame, max_labelled: int = MAX_LABELLED) -> Field | None:
    """The field learned from ``docs``' labelled rows, None if there are none."""
    rows, languages = labelled_sample(docs, max_labelled)
    if not languages:
        return None
    lexicon = frequent_words(rows, LEXICON)
    k, features = len(languages), (1 << BITS) + len(lexicon)
    field = Field(languages, lexicon, np.zeros((features, k)), np.zeros((k + 1, k)))
    for nth in range(ROUNDS if k > 1 else 0):
        # SHARDS rows of a fixed size.
        parts = rows.groupBy("shard").applyInPandas(_one_pass(field, nth), "n long, weights binary, moves binary").collect()
        if not parts:
            break
        share = np.array([r["n"] for r in parts], dtype=float)
        share /= share.sum()
        weights = sum(s * np.frombuffer(r["weights"], dtype=np.float32).reshape(features, k) for s, r in zip(share, parts))
        moves = sum(s * np.frombuffer(r["moves"]).reshape(k + 1, k) for s, r in zip(share, parts))
        field = Field(languages, lexicon, weights, moves)
    return field


# -- labelling -----------------------------------------------------------------
class Labeller:
    """Labels the words of blocks of texts."""

    def __init__(self, field: Field):
        self.field = field
        self.features = WordFeatures(field.lexicon)

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, place, marginals)`` of the words that hold a letter."""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        text = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        codes, distinct = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
        # Numbers such as a half are word characters without being letters.
        real = np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in distinct), dtype=bool, count=len(distinct))
        if not real.all():
            kept = real[codes]
            text, place, codes = text[kept], place[kept], codes[kept]
        if not len(codes):
            return text, place, np.zeros((0, len(self.field.languages)))
        word, feature = self.features(list(distinct))
        potentials = self.field.potentials(self.field.scores(word, feature, len(distinct)))
        counts = np.bincount(text, minlength=len(texts))
        return text, place, marginals(potentials, codes, counts[counts > 0], self.field.moves)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in blocks of about ``BLOCK_CHARS`` (or one text)."""
    for batch in batches:
        sizes = batch["text"].str.len().fillna(0).to_numpy()
        block = (np.cumsum(sizes) // BLOCK_CHARS).astype(int)
        for _, rows in batch.groupby(block, sort=True):
            yield rows


def _predict(field: Field):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Labeller(field)
        names = np.array(field.languages, dtype=object)
        for rows in _blocks(batches):
            text, _, found = of([words_of(t) for t in rows["text"]])
            votes = np.stack([np.bincount(text, weights=found[:, k], minlength=len(rows)) for k in range(len(names))], axis=1)
            total = votes.sum(axis=1)
            some = total > 0
            lang = np.where(some, names[votes.argmax(axis=1)], UNDETERMINED)
            score = np.where(some, votes.max(axis=1) / np.where(some, total, 1.0), 0.0)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "lang_pred": lang, "score": np.minimum(1.0, score)})

    return run


def _labels(field: Field):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Labeller(field)
        for rows in _blocks(batches):
            spans = [[m.span() for m in WORD.finditer(t or "")] for t in rows["text"]]
            words = [[t[a:b].lower() for a, b in s] for t, s in zip(rows["text"], spans)]
            text, place, found = of(words)
            best = found.argmax(axis=1)
            out: list[list[dict]] = [[] for _ in spans]
            for i, p, k, s in zip(text.tolist(), place.tolist(), best.tolist(), found.max(axis=1).tolist() if len(found) else []):
                begin, end = spans[i][p]
                out[i].append({"begin": begin, "end": end, "lang": field.languages[k], "score": s})
            yield pd.DataFrame({"doc_id": rows["doc_id"], "words": out})

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def label_words(docs: DataFrame, field: Field) -> DataFrame:
    """``(doc_id, words)``: where each word stands (code points), its language and the marginal of that."""
    return _texts(docs).mapInPandas(_labels(field), LABELLED)


def language_of(docs: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row; see the module docstring."""
    field = fit_field(docs, max_labelled)
    texts = _texts(docs)
    if field is None:
        predicted = texts.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        predicted = texts.mapInPandas(_predict(field), PREDICTED)
    return predicted.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
