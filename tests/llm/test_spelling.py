"""Operator 11 against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightshift.llm import spelling
from nightshift.llm.spelling import near_words, roots, spelling_variants, word_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def counts(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def all_pairs(n):
    out = {}
    words = sorted(n)
    for w in words:
        near = sorted((x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)), key=lambda x: (-n[x], x))
        form = near[0] if near and n[near[0]] >= 10 * n[w] else None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w in words:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def random_words(seed, letters, count, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(7, longest))) for _ in range(count)]


@pytest.mark.parametrize("tile", [2, 5, 2048])
def test_against_all_pairs(spark, tile):
    """Dense buckets: few letters, so that words have many neighbours; small tiles part them."""
    words = list(dict.fromkeys(random_words(3, "aÿ", 2_000, 8)))
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(words[: rng.choice((5, 40, len(words)))]).title() for _ in range(300))) for i in range(40)]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    want = all_pairs(counts(rows))
    got = spelling_variants(df, tile).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert len(got) == len(want) and any(v[0] for v in want.values()) and max(v[3] for v in want.values()) > 10


def test_odd_documents(spark):
    """Nulls, empty texts, repeated rows, a very long word, code points beside the letters, clashing columns."""
    long = "x" * 60_000
    rows = [
        (None, "thousand Thousand thousanb"), (1, None), (2, ""), (3, "ÀÉÎõöÿß ÀÉÎõöÿß àéîõöÿß àéîõöÿß"), (4, f"{long} {long}"), (4, f"{long} {long}"),
        (5, f"{long}y {long}y"), (6, "sevenup sevenup_sevenupÿ5sevenupÿ ĀsevenuppĀsevenupp"), (7, "short words only"), (8, "mul×iply mul×iply mul÷iply mul÷iply"),
    ]
    df = spark.createDataFrame([(i, t, None, "a", 1) for i, t in rows], DOCS)
    for c in ("word", "n", "length", "key", "size", "part"):
        df = df.withColumn(c, F.lit("x"))
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants(df).collect()}
    assert got == all_pairs(counts(rows))
    assert got[long][3] == 1


def test_no_words(spark):
    none = spelling_variants(spark.createDataFrame([], DOCS))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 0


def test_ties_go_to_the_smallest_word(spark):
    words = spark.createDataFrame([("zebrama", 50), ("zebrame", 50), ("zebramx", 2), ("zebrbmx", 3)], "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in near_words(words).collect()}
    assert got["zebramx"] == (3, "zebrama", 50) and got["zebrbmx"] == (1, "zebramx", 2)


def test_long_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert {r["root"] for r in roots(forms).collect()} == {"w37"}


def test_blocks_do_not_part_tiles():
    rows = pd.DataFrame({"length": 7, "segment": 0, "key": np.repeat(range(6), [1, 5, 2, 9, 1, 3]), "a": 0, "b": 0, "row": range(21)})
    for size in (1, 2, 3, 4, 7, 21):
        blocks = list(spelling._blocks(rows.iloc[i : i + size] for i in range(0, 21, size)))
        assert pd.concat(blocks)["row"].tolist() == list(range(21))
        assert sum(b["key"].nunique() for b in blocks) == 6


def test_word_counts_slips(spark):
    rows = [(i, "Wonderful evening") for i in range(400)]
    got = {r["word"]: r["n"] for r in word_counts(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)).collect()}
    assert got == counts(rows) and len(got) > 2
