"""Operator 7 against all pairs of lines, with repeated and null ids, and on lines of one template."""

import random

import pytest
from pyspark.sql import functions as F

from nightshift.llm import linededup
from nightshift.llm.linededup import dedup_lines

DOCS = "doc_id long, text string, lang string"


def shingles(line):
    words = [w for w in line.lower().split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else None


def by_all_pairs(rows):
    """``rows`` in the operator's order of documents; the kept text of each."""
    seen, out = [], []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        kept = []
        for line in text.split("\n"):
            s = shingles(line)
            if s is not None and any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                seen.append(s)
                continue
            if s is not None:
                seen.append(s)
            kept.append(line)
        out.append("\n".join(kept))
    return out


def in_order(df):
    return [(r["doc_id"], r["text"]) for r in df.withColumn("t", F.xxhash64("text")).orderBy("doc_id", "t").collect()]


def result(df):
    return sorted(((r["doc_id"], r["text"]) for r in dedup_lines(df).collect()), key=repr)


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], DOCS)
    placed = in_order(df)
    assert result(df) == sorted(zip([i for i, _ in placed], by_all_pairs(placed)), key=repr)


def test_unmatched_lines_of_repeated_ids_stay(spark):
    check(spark, [(1, "P"), (5, "X\nY"), (5, "P\nQ")])
    check(spark, [(None, "one line\nX"), (None, "X\nY"), (1, "y"), (None, "one line\nX"), (None, None)])


def test_equal_rows_keep_one_copy(spark):
    check(spark, [(3, "a b c\n\n d e f g h"), (3, "a b c\n\n d e f g h"), (3, "a b c\n\n d e f g h"), (2, "d  e f g h "), (2, "d  e f g h ")])
    df = spark.createDataFrame([(3, "a b\n \nc", "en")] * 4, DOCS)
    got = sorted((r["text"], r["n"]) for r in dedup_lines(df, "n").collect())
    assert got == [(" ", 2)] * 3 + [("a b\n \nc", 0)]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_against_all_pairs(spark, seed):
    """Lines cut from few phrases and changed a little, of all lengths, some ids twice."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(60)}" for _ in range(rng.choice((1, 2, 4, 5, 6, 9, 14, 25, 60, 150)))] for _ in range(25)]

    def line():
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 5))):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.choice((0, 1))] = rng.choice(([], [f"v{rng.randrange(9)}"]))
        return rng.choice((" ", " ", "  ")).join(words).title() if rng.random() < 0.3 else " ".join(words)

    check(spark, [(rng.choice((None, *range(30))), "\n".join(line() for _ in range(rng.randrange(8)))) for _ in range(60)])


def test_columns_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "same line"), (2, "same line\nx")], "doc_id long, text string")
    names = ("n_removed", "key", "token", "d", "t", "line", "gone", "first", "own", "place", "n", "w", "s")
    for c in names:
        df = df.withColumn(c, F.lit("mine"))
    got = dedup_lines(df)
    assert got.columns == df.columns
    assert sorted((r["text"], *[r[c] for c in names]) for r in got.collect()) == [("same line", *["mine"] * 13), ("x", *["mine"] * 13)]
    assert [r["n_removed"] for r in dedup_lines(df, "n_removed").orderBy("doc_id").collect()] == [0, 1]


def test_lines_of_a_template_meet_in_no_pair(spark):
    """All share four of their five shingles with all others and none matches."""
    lines = spark.range(3_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("one two three four five six seven eight "), F.col("id")).alias("text"))
    docs = lines.groupBy("doc_id").agg(F.array_join(F.collect_list("text"), "\n").alias("text")).withColumn("lang", F.lit("en"))
    firsts = linededup.first_places(linededup.line_places(docs))
    copies = linededup._first_copies(docs, firsts)
    posts = linededup.shared_prefixes(linededup.line_sets(copies, linededup.bucket_ranks(copies)), firsts)
    # But for a unique token in the hash bucket of a shared one, which then counts as frequent.
    assert linededup.earlier_pairs(posts, posts).count() < 10
    assert dedup_lines(docs).first()["text"].count("\n") == 2_999


def test_lines_without_a_match_go_no_further(spark):
    """No set is made of lines that hold too many shingles of their own; every line that matches another is left."""
    rng = random.Random(7)
    alone = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(120)) for _ in range(60)]
    near = []
    for n in (1, 4, 5, 9, 20, 60, 120):
        for _ in range(8):
            words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
            at = rng.randrange(n)
            near += [" ".join(words), " ".join([*words[:at], "x", *words[at + 1 :]]), " ".join([*words, "x"]), " ".join(words[1:] or ["y"])]
    periodic = ["a b c d e f " * 20, "a b c d e f " * 21 + "g"]
    rows = [(i, line) for i, line in enumerate(alone + near + periodic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    firsts = linededup.first_places(linededup.line_places(docs))
    left = {r["first"]["d"] for r in linededup.lines_left(linededup._first_copies(docs, firsts), firsts).collect()}
    assert not left & set(range(len(alone)))
    sets, placed = [shingles(line) for _, line in rows], {r["first"]["d"] for r in firsts.collect()}
    matched = {i for i in placed for j in placed if i != j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert len(matched) > 20 and matched <= left
