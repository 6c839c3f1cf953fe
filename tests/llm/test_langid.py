"""Operator 13: exact marginals by enumeration, the gradient by differences, held-out accuracy, code-switched words."""

import re
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightshift.llm import langid
from nightshift.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def enumerated(potentials, words, moves):
    """Marginals and log of the sum over all label sequences, one by one."""
    k = potentials.shape[1]
    total, out = 0.0, np.zeros((len(words), k))
    for path in product(range(k), repeat=len(words)):
        x, before = 1.0, k
        for w, y in zip(words, path):
            x *= np.exp(moves[before, y]) * potentials[w, y]
            before = y
        total += x
        for t, y in enumerate(path):
            out[t, y] += x
    return out / total, np.log(total)


@pytest.mark.parametrize("segment", [1, 2, 3, 128])
def test_marginals_by_enumeration(segment):
    rng = np.random.default_rng(5)
    sizes = np.array([1, 6, 2, 3, 5, 1, 6])
    potentials, moves = np.exp(rng.normal(size=(9, 3))), rng.normal(size=(4, 3))
    words = rng.integers(9, size=sizes.sum())
    got = langid.marginals(potentials, words, sizes, moves, segment)
    want = np.concatenate([enumerated(potentials, w, moves)[0] for w in np.split(words, np.cumsum(sizes)[:-1])])
    assert np.allclose(got, want, atol=1e-6)


def test_marginals_of_long_texts_are_those_of_one_walk():
    rng = np.random.default_rng(6)
    potentials, moves = np.exp(3 * rng.normal(size=(50, 4))), rng.normal(size=(5, 4))
    sizes = np.array([5_000, 3, 129, 128])
    words = rng.integers(50, size=sizes.sum())
    whole = langid.marginals(potentials, words, sizes, moves, 5_000)
    assert np.allclose(langid.marginals(potentials, words, sizes, moves), whole, atol=1e-5)
    assert np.allclose(whole.sum(axis=1), 1, atol=1e-5)


def test_gradient_by_differences(monkeypatch):
    rng = np.random.default_rng(7)
    words, labels = rng.integers(5, size=(2, 4)), rng.integers(3, size=(2, 4))
    scores, moves = rng.normal(size=(5, 3)), rng.normal(size=(4, 3))

    def likelihood(scores, moves):
        out = 0.0
        for w, y in zip(words, labels):
            path = sum(scores[a, b] for a, b in zip(w, y)) + moves[3, y[0]] + sum(moves[a, b] for a, b in zip(y, y[1:]))
            out += path - enumerated(np.exp(scores), w, moves)[1]
        return out

    field = langid.Field(["a", "b", "c"], [], np.zeros((1, 3)), moves)
    by_word, by_move = langid._gradient(field, np.exp(scores), words, labels)
    g = np.zeros_like(scores)
    np.add.at(g, words, by_word)
    for of, x in ((g, scores), (by_move, moves)):
        for at in np.ndindex(x.shape):
            d = np.zeros_like(x)
            d[at] = 1e-5
            a = likelihood(scores + d, moves) if x is scores else likelihood(scores, moves + d)
            b = likelihood(scores - d, moves) if x is scores else likelihood(scores, moves - d)
            assert abs((a - b) / 2e-5 - of[at]) < 1e-5


def test_features_of_a_word_stand_alone():
    of = langid.WordFeatures(["the", "ß"])
    words = ["the", "a", "straße", "ß", "x" * 300]
    word, feature = of(words)
    for i, w in enumerate(words):
        own = of([w])[1]
        assert sorted(feature[word == i]) == sorted(own)
        n = len(w) + 2
        grams = len(w) + (n - 1) + max(0, n - 2) + sum(min(2, max(0, n - k + 1)) for k in (4, 5))
        assert len(own) == grams + (w in of.lexicon)
    assert feature.max() < of.size


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def field(docs):
    return langid.fit_field(docs)


def test_held_out_accuracy(spark, docs):
    got = QUERIES["op13_language_id"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    unseen = [r for r in rows if r["held_out"]]
    assert len(unseen) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in unseen]) > 0.98


def test_prediction_is_the_sum_of_plain_marginals(spark, docs, field):
    """A walk over each text, word by word, without blocks, segments or shared words."""
    some = docs.orderBy("doc_id").limit(60)
    got = {r["doc_id"]: r for r in spark.createDataFrame(some.toPandas()).transform(lambda d: d.mapInPandas(langid._predict(field), langid.PREDICTED)).collect()}
    step = np.exp(field.moves)
    for r in some.collect():
        words = [w for w in re.findall(r"[^\W\d_]+", r["text"].lower())]
        e = []
        for w in words:
            _, feature = langid.WordFeatures(field.lexicon)([w])
            s = field.weights[feature].sum(axis=0) / np.sqrt(len(feature))
            e.append(np.exp(s - s.max()))
        forward = [step[-1] * e[0]]
        for x in e[1:]:
            f = (forward[-1] @ step[:-1]) * x
            forward.append(f / f.sum())
        backward, votes = np.ones(len(step) - 1), 0.0
        for t in range(len(e) - 1, -1, -1):
            p = forward[t] * backward
            votes = votes + p / p.sum()
            b = step[:-1] @ (e[t] * backward)
            backward = b / b.sum()
        assert got[r["doc_id"]]["lang_pred"] == field.languages[int(np.argmax(votes))]
        assert abs(got[r["doc_id"]]["score"] - votes.max() / votes.sum()) < 1e-4


def test_code_switched_words(spark, docs, field):
    """Spans of held-out documents of two languages in one text: each word gets the language of its span."""
    held = docs.where(langid.held_out(F.col("doc_id"))).select("text", "lang").orderBy("doc_id").collect()
    of = {lang: [w for r in held if r["lang"] == lang for w in r["text"].split()][:3_000] for lang in field.languages}
    rows, want = [], {}
    for i, (a, b) in enumerate([(a, b) for a in field.languages for b in field.languages if a < b]):
        spans = [(lang, of[lang][at : at + 15]) for at in range(0, 150, 15) for lang in (a, b)]
        rows.append((i, " ".join(w for _, s in spans for w in s)))
        want[i] = [lang for lang, s in spans for w in s for _ in langid.WORD.findall(w.lower())]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    texts, right = dict(rows), []
    for r in langid.label_words(df, field).collect():
        assert len(r["words"]) == len(want[r["doc_id"]])
        for w, lang in zip(r["words"], want[r["doc_id"]]):
            assert langid.WORD.fullmatch(texts[r["doc_id"]][w["begin"] : w["end"]])
            right.append(w["lang"] == lang)
    assert np.mean(right) > 0.93


def odd_rows(long):
    return [
        (1, None, "en"), (2, "", "en"), (3, " 12 ½ ²³ _ !?", "de"), (None, "der und die", "de"), (4, long, None), (5, "the and of", "en"),
        (5, "the and of", "en"), (6, "ıİ ﬀ \U00010400 中文", None), (7, "x" * 200_000, "en"),
    ]


def test_odd_documents(spark):
    long = "the and of " * 40_000
    df = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in odd_rows(long)], DOCS)
    for c in ("lang_pred", "score", "held_out", "words", "shard", "count"):
        df = df.withColumn(c, F.lit("x"))
    got = langid.language_of(df).collect()
    assert len(got) == df.count()
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert all(by[i]["lang_pred"] in ("en", "de") and 0 < by[i]["score"] <= 1 for i in (4, 5, 6, 7, None))
    assert by[None]["held_out"] is False


def test_one_language_none_and_no_rows(spark):
    rows = [(i, f"some words {i}", "en", None, None) for i in range(1, 9)]
    assert {(r["lang_pred"], r["score"]) for r in langid.language_of(spark.createDataFrame(rows, DOCS)).collect()} == {("en", 1.0)}
    unlabelled = spark.createDataFrame([(i, t, None, None, None) for i, t, *_ in rows], DOCS)
    assert {(r["lang_pred"], r["score"]) for r in langid.language_of(unlabelled).collect()} == {("und", 0.0)}
    assert langid.language_of(spark.createDataFrame([], DOCS)).count() == 0


def test_held_out_rows_teach_nothing(spark):
    """Languages that only held-out rows have, or rows without id, aren't learned."""
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "ein wort und noch eins" if i in held else "a word and one more", "de" if i in held else "en", None, None) for i in range(60)]
    rows.append((None, "un mot et encore un", "fr", None, None))
    assert {r["lang_pred"] for r in langid.language_of(spark.createDataFrame(rows, DOCS)).collect()} == {"en"}
