"""Operator 12 against a plain recursion over the same definitions."""

import hashlib
import zlib

from pyspark.sql import functions as F

from nightshift.llm import merkle
from nightshift.llm.merkle import verified_manifest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, proofs):
    """Root of ``(digest, members)`` nodes; every member's proof gains its run's others."""
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), 8):
            run = nodes[i : i + 8]
            digests = [d for d, _ in run]
            for j, (_, members) in enumerate(run):
                for m in members:
                    proofs[m].append(("".join(digests[:j]), "".join(digests[j + 1 :])))
            above.append((H(*digests), [m for _, ms in run for m in ms]))
        nodes = above
    return nodes[0]


def by_recursion(rows):
    leaf = [H(*[written(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]) for r in rows]
    proofs = [[] for _ in rows]
    subs, subroot = [], {}
    for lang in sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        own = [i for i, r in enumerate(rows) if r["lang"] == lang]
        own.sort(key=lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, leaf[i]))
        sub = climb([(leaf[i], [i]) for i in own], proofs)
        subs.append(sub)
        subroot.update(dict.fromkeys(sub[1], sub[0]))
    root = climb(subs, proofs)[0] if subs else None
    out = []
    for i, r in enumerate(rows):
        now = leaf[i]
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            now = H(*[written(r[c]) for c in ("doc_id", "source", "lang", "n_chars")], written(low))
        for a, b in proofs[i]:
            now = H(a, now, b)
        out.append((r["doc_id"], leaf[i], subroot[i], root, H(*[a + b for a, b in proofs[i]]), now, now == root))
    return out


def compare(df):
    got = verified_manifest(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = df.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, by_recursion(rows)))
    return got


def test_documents(spark):
    compare(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_documents(spark):
    """Nulls in every column, empty and long texts, equal rows, one id with two texts, lone groups, clashing columns."""
    rows = [
        (1, "Same", "en", "a", 4), (1, "Same", "en", "a", 4), (1, "Other", "en", "a", 5), (None, "no id", "en", None, None),
        (None, None, None, None, None), (2, "", "en", "a", 0), (3, None, "", "a", None), (4, "X" * 300_000, "ß", "a", 1), (-7, "ÀÉ upper Z", "zz", "-", 3),
    ]
    df = spark.createDataFrame(rows + [(i, f"Text {i}", "en", "a", i) for i in range(100, 700)], DOCS)
    for c in ("digest", "lo", "hi", "n", "bucket", "children", "proof", "root", "place", "whole"):
        df = df.withColumn(c, F.lit("x"))
    compare(df)


def test_one_group_one_leaf_and_no_rows(spark):
    row = [(5, "alone", "en", "a", 5)]
    alone = compare(spark.createDataFrame(row, DOCS)).first()
    assert alone["leaf"] == alone["subroot"] == alone["root"] and alone["proof_sha256"] == H()
    compare(spark.createDataFrame(row * 9, DOCS))  # a run of eight, then a run of one
    assert verified_manifest(spark.createDataFrame([], DOCS)).count() == 0


def test_intervals_nest(spark):
    """Each node's interval is the union of its children's, and its siblings' are the rest of its parent's."""
    leaves = spark.range(150).select(F.lit("g").alias("g"), F.col("id").alias("lo"), (F.col("id") + 1).alias("hi"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(150).alias("n"))
    levels = [x.orderBy("lo").collect() for x in merkle.grow(leaves, "g", "test")]
    assert [len(x) for x in levels] == [19, 3, 1]
    for nodes in levels:
        assert nodes[0]["lo"] == 0 and nodes[-1]["hi"] == 150
        assert all(a["hi"] == b["lo"] for a, b in zip(nodes, nodes[1:]))
        for x in nodes:
            ends = [(c["lo"], c["hi"]) for c in x["children"]]
            assert (ends[0][0], ends[-1][1]) == (x["lo"], x["hi"]) and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
