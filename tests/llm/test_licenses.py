"""Operator 3 on whole license texts, against a plain walk over diagonals."""

import random
import re

import pytest

from nightshift.llm import licenses
from nightshift.llm.license_texts import TEXTS

WHOLE = licenses.templates()[len(licenses.PHRASES) + len(licenses.NOTICES) :]


def words(text):
    return [w for w in re.split(licenses.SEPARATORS, text.lower()) if w]


def by_walking(text):
    """Labels and best score of a text: every template at every diagonal, neighbours merged."""
    ws, labels, best = words(text), set(), 0.0
    for length_words, label, phrase, pairs in licenses.templates():
        votes = sorted((p - t, t, p) for t, a, b in pairs for p in range(len(ws) - 1) if (ws[p], ws[p + 1]) == (a, b))
        spans = []
        for v in votes:
            if spans and v[0] - spans[-1][-1][0] <= (0 if phrase else licenses.GAP):
                spans[-1].append(v)
            else:
                spans.append([v])
        for span in spans:
            score = len({t for _, t, _ in span}) / len(pairs)
            reach = max(p for *_, p in span) + 2 - min(p for *_, p in span)
            if score >= (1.0 if phrase else licenses.COVERAGE) and reach <= licenses.SLACK * len(length_words) + licenses.GAP:
                labels.add(label)
                best = max(best, score)
    return ",".join(sorted(labels)), best


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.license_scan(df).collect()}


def test_templates_are_longer_than_one_mask():
    assert max(len(pairs) for *_, pairs in WHOLE) > 2 * licenses.MASK_BITS


def test_whole_texts_are_found(spark):
    got = scan(spark, ["Some code.\n" + text + "\nint main() {}" for text, _ in TEXTS])
    for at, (_, label) in enumerate(TEXTS):
        assert label in got[at]["labels"].split(",") and got[at]["score"] == 1.0


@pytest.mark.parametrize("seed", range(2))
def test_changed_texts_against_a_walk(spark, seed):
    """Texts cut, with words put in, left out and replaced, side by side."""
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        ws = []
        for text, _ in rng.sample(TEXTS, rng.choice((1, 1, 2))):
            part = text.split()
            part = part[rng.choice((0, 0, len(part) // 5, len(part) // 2)) :]
            for _ in range(rng.choice((0, 1, 3, 12))):
                at = rng.randrange(len(part) + 1)
                part[at : at + rng.choice((0, 1))] = rng.choice(([], ["Acme"], ["the", "software"]))
            ws += ["lead"] * rng.randrange(3) + part
        texts.append(" ".join(ws))
    got = scan(spark, texts)
    for at, text in enumerate(texts):
        labels, score = by_walking(text)
        assert (got[at]["labels"], got[at]["score"]) == (labels, pytest.approx(score))
    assert len({r["labels"] for r in got.values()}) > 8


def test_half_a_text_is_no_license(spark):
    halves = [" ".join(text.split()[len(text.split()) // 2 :]) for text, label in TEXTS if label in ("isc", "unlicense")]
    assert all(r["labels"] == "" for r in scan(spark, halves).values())
