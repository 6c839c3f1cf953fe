"""Operators that SQL can't express, against brute force, round trips and held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from nightshift.llm import chat, fingerprints, licenses, linededup, mixing, pieces, sharding, simhash, toxicity, vectors
from nightshift.llm.components import connected_components
from nightshift.llm.queries import MIX, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.orderBy("doc_id").collect()]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOCS)


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} the idiot and" for i in range(20_000))
    rows = [
        (1, "the cat sat on the mat\n\nthe cat sat on the mat", "en", "a"),
        (2, None, None, None), (3, "", "en", "a"), (None, "no id at all, but five words", None, "b"),
        (4, "x" * 5_000, "en", "b"), (5, long, "en", "a"), (5, long, "en", "a"), (5, "same id, other text", "en", "a"),
        (6, "  \n \t ", "en", "a"), (7, "▁ mark \u0000 \U0001f600 ẞİ", "de", None),
    ]
    df = frame(spark, rows)
    return df.withColumn("key", F.lit("k")).withColumn("n", F.lit(1)).withColumn("token", F.lit(2)).withColumn("part", F.lit(0)).withColumn("score", F.lit("s"))


# -- op1 ---------------------------------------------------------------------
EDGES = ".,;:!?\"'()[]{}<>-_*#~`|/\\"


def plain_signatures(text, common):
    """Signatures word by word: ``(anchor, next two content words)``, without hashes but for the choice of the least one."""
    words = [w for w in (t.strip(EDGES) for t in text.lower().split()) if w]
    code = {w: (xxhash.xxh64_intdigest(w.encode()) | 3) ^ 3 or 4 for w in words}
    anchor = {i for i, w in enumerate(words) if w in common}
    width = min(4, len(words))
    for i in range(len(words) - width + 1 if words else 0):
        window = range(i, i + width)
        if not any(words[j] in common for j in window):
            anchor.add(max(window, key=lambda j: (-code[words[j]], j)))
    out = set()
    for i in anchor:
        chain = [w for w in words[i + 1 :] if w not in common][:2]
        out.add((words[i], *chain, *[None] * (2 - len(chain))))
    return out


def plain_common(texts):
    n = Counter(w for t in texts for w in set(t.lower().split()) if re.fullmatch(r"[^\W\d_]+", w))
    return {w for w, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:64]}


def plain_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_by_hand(spark, docs, texts):
    got = {r["doc_id"]: r for r in fingerprints.document_fingerprints(docs).collect()}
    common = plain_common([t for _, t in texts])
    assert common == set(fingerprints.common_words(docs)) and len(common) == 64
    assert len(got) == len(texts)
    for at, (doc_id, text) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        a, b, c = (plain_signatures(t, common) for t in (text, edited, after))
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints = re.findall("." * 8, r["fingerprint"])
        assert prints == sorted(prints) and len(set(prints)) == len(prints) == len(a) == r["n_signatures"]
        assert abs(r["near_edited"] - plain_likeness(a, b)) < 1e-6
        assert abs(r["near_next"] - plain_likeness(a, c)) < 1e-6


def test_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rows = [(i * 3, f"text number {i} " * (i % 5 + 1), "en", "a") for i in range(100)]
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.document_fingerprints(frame(spark, rows)).collect()}
    for at, (doc_id, text, *_) in enumerate(rows):
        after, half = rows[(at + 1) % 100][1], len(text) // 2
        assert got[doc_id] == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()


def test_near_duplicates_finds_all_pairs(spark, docs, texts):
    common = plain_common([t for _, t in texts])
    sets = {frozenset(plain_signatures(t, common)) for _, t in texts}
    want = sorted(round(plain_likeness(a, b), 9) for a, b in combinations([s for s in sets if s], 2) if plain_likeness(a, b) >= 0.8)
    got = fingerprints.near_duplicates(docs).collect()
    assert sorted(round(r["jaccard"], 9) for r in got) == want and want
    assert len({frozenset((r[0], r[1])) for r in got}) == len(got)


def test_signatures_have_one_kind_and_no_gaps():
    """At least one of any four words in a row is an anchor, and a removed word changes few signatures, common words or not."""
    words = fingerprints._Words(["the"])
    for n in (1, 2, 3, 31, 32, 33, 400):
        for every in (2, 3, 1_000):
            tokens = [f"x{i}" if i % every else "the" for i in range(n)]
            codes = np.array([words[t] for t in tokens], dtype=np.uint64)
            gaps = np.diff(np.r_[-1, np.flatnonzero(fingerprints.anchors(codes)), n])
            assert gaps.max() <= 4
            a = fingerprints.spot_signatures(" ".join(tokens), words)
            assert len(a) >= n // 4
            if n >= 100:
                b = fingerprints.spot_signatures(" ".join(tokens[: n // 2] + tokens[n // 2 + 1 :]), words)
                assert fingerprints.likeness(a, b) >= 0.9
    assert len(fingerprints.spot_signatures(" .,; ", words)) == 0


# -- op2 ---------------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = spark.createDataFrame(QUERIES["op2_toxicity"](spark, sf).toPandas())
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    assert toxic and clean and all(0 <= s <= 1 for s in toxic + clean)
    assert np.mean([a > b for a in toxic for b in clean]) > 0.85
    assert np.mean([r["predicted"] == 0 for r in rows if r["toxic"] == 0]) > 0.97
    for r in got.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_toxicity_without_classes(spark):
    odd = odd_documents(spark)
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_scores(odd, none).collect()
    assert len(got) == odd.count() and {r["score"] for r in got} == {0.5}
    assert toxicity.drop_toxic(odd, none, 0.6).columns == odd.columns


# -- op3 ---------------------------------------------------------------------
def test_license_phrases_and_notices(spark):
    mit, lead = licenses.NOTICES[0][0], "some words first. "
    cut_mit = mit.replace("any person ", "anyone ").title()
    rows = [
        (1, "MIT License, mit-license and MIT  LICENSE", "en", "a"), (2, "general public public license", "en", "a"),
        (3, lead + cut_mit, "en", "a"), (4, "a mitten license", "en", "a"), (5, None, "en", "a"),
        (6, "GNU General Public Licenseİ general public license", "en", "a"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, rows)).collect()}
    assert [got[1][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == [7, 3, 0, 5, "mit"]
    assert (got[2]["n_base"], got[2]["labels"]) == (0, "")
    assert (got[3]["base_labels"], got[3]["labels"]) == ("", "mit") and 0.75 <= got[3]["score"] < 1
    assert (got[4]["n_base"], got[5]["n_words"], got[5]["score"]) == (0, 0, 0.0)
    assert (got[6]["n_base"], got[6]["first_word"]) == (1, 4)


# -- op4 ---------------------------------------------------------------------
def test_hilbert_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        cells = spark.range(1 << (n * bits)).select(*[F.shiftright("id", bits * k).bitwiseAND((1 << bits) - 1).alias(f"c{k}") for k in range(n)])
        rows = cells.select("*", sharding.hilbert_index([F.col(f"c{k}") for k in range(n)], bits).alias("h")).orderBy("h").collect()
        assert [r["h"] for r in rows] == list(range(1 << (n * bits)))
        assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_law_and_files(spark, docs, texts, tmp_path):
    rows = sharding.shard_digest(docs).collect()
    by = dict(texts)
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts) and set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    for r in rows:
        raw = by[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    for s in range(40):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    in_order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["hilbert"] for r in in_order] == sorted(r["hilbert"] for r in rows)
    sharding.write_shards(docs, f"{tmp_path}/out", 40)
    back = spark.read.parquet(f"{tmp_path}/out").groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in back} == sizes


# -- op5 ---------------------------------------------------------------------
def test_pieces_round_trip_and_repeat(spark, docs, texts):
    odd = odd_documents(spark)
    for df in (docs, odd.drop("token", "part")):
        got = pieces.encode(df, F.col("doc_id"), F.col("text")).select("doc_id", "text", "pieces.*")
        back = pieces.decode(got, F.col("ids")).collect()
        assert all(r["lossless"] and r["decoded"] == (r["text"] or "") for r in back)
    whole = {r["doc_id"]: r["ids"] for r in pieces.piece_digest(docs).collect()}
    alone = {r["doc_id"]: r["ids"] for r in pieces.piece_digest(docs.repartition(7)).collect()}
    other = {r["doc_id"]: r["ids"] for r in pieces.piece_digest(docs, seed=1).collect()}
    assert whole == alone and whole != other


def test_pieces_follow_the_exact_distribution():
    vocabulary = pieces.Vocabulary.load()
    sampler = pieces.Sampler(vocabulary, 0.3, 0)
    ids = {p: i for i, p in enumerate(vocabulary.pieces) if p}

    def paths(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in ids:
                for tail, weight in paths(rest[n:]):
                    yield (ids[rest[:n]], *tail), weight + sampler.lattice.weight[ids[rest[:n]]]

    word, n = "thonin", 20_000
    want = {k: np.exp(w) for k, w in paths("▁" + word)}
    total = sum(want.values())
    got = Counter(tuple(x.tolist()) for x in sampler.encode([str(i) for i in range(n)], [word] * n))
    assert set(got) <= set(want) and len(want) > 20
    assert sum(abs(w / total - got.get(k, 0) / n) for k, w in want.items()) / 2 < 0.03


# -- op6 ---------------------------------------------------------------------
def test_event_log_is_folded(spark):
    rows = [
        (1, 0, "start", "a", "user", ""), (1, 1, "delta", "a", None, "hel"), (1, 2, "delta", "a", None, "lo"),
        (1, 3, "start", "b", "assistant", ""), (1, 4, "delta", "b", None, "first"), (1, 5, "start", "c", "user", "later"),
        (1, 6, "regenerate", "b", None, ""), (1, 7, "delta", "b", None, "second <|im_end|>"), (1, 8, "edit", "a", None, "bye\\n"),
        (None, 0, "start", "z", None, None),
    ]
    log = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message string, role string, text string")
    made = {r["conv_id"]: r for r in chat.format_events(log).collect()}
    assert made[1]["formatted"] == "<|im_start|>user\nbye\\\\n<|im_end|>\n<|im_start|>assistant\nsecond <\\|im_end|><|im_end|>\n"
    read = {r["conv_id"]: r for r in chat.read_back(chat.format_events(log)).collect()}
    assert read[1]["n_turns"] == 2 and read[1]["loss_sha256"] == hashlib.sha256(b"second <|im_end|>").hexdigest()
    assert read[1]["turns_sha256"] == hashlib.sha256(b"user\nbye\\n\nassistant\nsecond <|im_end|>\n").hexdigest()
    assert read[None]["n_turns"] == 1
    assert chat.read_back(chat.format_events(log.limit(0))).count() == 0


def test_turn_ties_and_nulls(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (1, 1, "as\nsistant", "\\<|")],
        "conv_id long, turn long, role string, text string",
    )
    got = chat.read_back(chat.format_events(chat.turns_as_events(turns))).first()
    assert got["n_turns"] == 4
    assert got["turns_sha256"] == hashlib.sha256(b"\n\nuser\nx\nuser\nx\nas\nsistant\n\\<|\n").hexdigest()


def test_logs_of_turns_hold_drafts_and_edits(spark):
    """Turns that share numbers, roles and texts, through logs with regenerations and edits."""
    rows = [(c, t, role, f"text {c} {t} {k} " * (k % 4)) for c in range(40) for t in range(3) for k, role in enumerate(("user", "assistant", "tool"))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.turns_as_events(turns)
    kinds = {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds["regenerate"] > 50 and kinds["edit"] > 50 and kinds["delta"] > 3 * len(rows)
    hashed = {r["text"]: r["h"] for r in turns.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    for r in chat.read_back(chat.format_events(log)).collect():
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1], x[2], str(hashed[x[3]])))
        assert r["n_turns"] == 9
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in own).encode()).hexdigest()


# -- op7 ---------------------------------------------------------------------
def test_line_dedup_near_lines(spark):
    line = " ".join(f"w{i}" for i in range(60))
    near = line.replace("w30", "other")
    rows = [
        (2, f"{near}\nshort line\nkeep this one line alone here", "en", "a"), (1, f"{line}\nshort line", "en", "a"),
        (3, f"{line}\n{line}", "en", "a"), (None, line.upper(), "en", "a"), (4, None, None, None), (5, "", None, None),
    ]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(frame(spark, rows), "n_removed").collect()}
    # Lines of few words take part: as one shingle they match their repeats.
    assert got[None]["text"] == line.upper() and got[1]["text"] == "short line"
    assert got[2]["text"] == "keep this one line alone here" and got[3]["text"] == ""
    assert (got[4]["text"], got[5]["text"], got[3]["n_removed"]) == (None, "", 2)


# -- op8 ---------------------------------------------------------------------
def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, centre = [], rng.normal(size=(6, 32))
    for i in range(1_500):
        c = i % 6 if i < 600 else None
        v = centre[c] + rng.normal(size=32) * 0.09 if c is not None else rng.normal(size=32)
        rows.append((i, [float(x) for x in v.astype(np.float32)], 1 if i % 3 else 2))
    rows += [(2_000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(3_000, None, 1), (3_001, [0.0] * 32, 1), (3_002, [float("nan")] * 32, 1), (3_003, rows[0][1], None), (3_004, [], 1), (3_005, [None] * 32, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit(0))
    got = {r["vec_id"]: r for r in vectors.vector_digest(df).collect()}
    good = [(i, np.array(v, dtype=float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ids, m, lab = [g[0] for g in good], np.array([g[1] for g in good]), np.array([g[2] for g in good])
    norm = np.linalg.norm(m, axis=1)
    near = ((m @ m.T) / np.outer(norm, norm) >= 0.98) & (lab[:, None] == lab)
    np.fill_diagonal(near, False)
    low = np.arange(len(ids))
    for _ in range(len(ids)):
        new = np.minimum(low, np.where(near, low[None, :], len(ids)).min(axis=1))
        if (new == low).all():
            break
        low = new
    assert near.sum() > 1_000 and len(got) == len(rows)
    found = sum(got[i]["n_links"] for i in ids)
    assert found >= 0.99 * near.sum() and all(got[i]["n_links"] <= d for i, d in zip(ids, near.sum(axis=1)))
    assert [got[i]["component_id"] for i in ids] == [ids[x] for x in low]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(3_000, 3_006))


def test_oversize_shards_are_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 16))
    v = np.repeat(base, 3, axis=0) + rng.normal(size=(600, 16)) * 0.01
    df = spark.createDataFrame([(i, [float(y) for y in x], 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 70)
    got = vectors.vector_digest(df).collect()
    assert sum(r["n_links"] for r in got) == 1_200 and all(r["component_id"] == r["vec_id"] // 3 * 3 for r in got)


def _sparse_links(spark):
    """20 pairs and one group of 60 near copies among 3,000 vectors."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=(3_000, 24))
    v[1:40:2] = v[0:40:2] + rng.normal(size=(20, 24)) * 0.01
    v[100:160] = v[100] + rng.normal(size=(60, 24)) * 0.01
    rows = [(i, [float(y) for y in x], 1) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "vec_id long, v array<double>, label int")


def test_audit_sees_missed_pairs_beside_a_large_group(spark):
    made = vectors.distinct_vectors(_sparse_links(spark)).cache()
    truth = vectors.true_links(made, 0.98)
    want = {i: 1 for i in range(40)} | {i: 59 for i in range(100, 160)}
    asked = {r["first"]: r["true"] for r in truth.join(made, "key").collect()}
    assert len(asked) >= vectors.AUDIT_LINKED and all(want[i] == n for i, n in asked.items())
    whole = made.select("key", F.when(F.col("first") < 40, 1).when(F.col("first").between(100, 159), 59).otherwise(0).alias("links"))
    assert vectors.audit_recall(truth, whole) == 1.0
    assert vectors.audit_recall(truth, whole.where("links <> 1")) < 0.9


def test_too_low_recall_raises(spark, monkeypatch):
    links = vectors.unit_links
    monkeypatch.setattr(vectors, "unit_links", lambda *a: links(*a).where("links > 1"))
    with pytest.raises(RuntimeError, match="recall"):
        vectors.near_vectors(_sparse_links(spark))


# -- op9 ---------------------------------------------------------------------
def _simhash(text, shingle):
    words = text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_hand(spark, docs, texts):
    got = {r["doc_id"]: r for r in simhash.simhash_digest(docs, 3, 2).collect()}
    want = {i: _simhash(t, 3) for i, t in texts}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{h:016x}" for i, h in want.items()}
    least = {i: i for i in want}
    links = [(a, b) for a, b in combinations(want, 2) if (want[a] ^ want[b]).bit_count() <= 2]
    for _ in want:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert {i: r["component_id"] for i, r in got.items()} == least


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [2, 1_000])
def test_masks_cover_the_radius(spark, radius, bucket):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(0, 1 << 62, 12)]
    prints = sorted({b ^ sum(1 << int(i) for i in rng.choice(62, k, replace=False)) for b in base for k in range(4) for _ in range(6)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.fingerprint_links(df, radius, bucket).collect()}
    near = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= radius]
    assert all((a ^ b).bit_count() <= radius for a, b in got)

    def parts(links):
        low = {p: p for p in prints}
        for _ in prints:
            for a, b in links:
                low[a] = low[b] = min(low[a], low[b])
        return low

    assert parts(got) == parts(near)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# -- op10 --------------------------------------------------------------------
def test_rates_meet_targets_and_equal_a_local_solution(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4, 0.3, 0.2], size=400)
    n = rng.integers(1, 500, size=400)
    rows = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(n, p)], "n_tokens long, p_0 double, p_1 double, p_2 double")
    targets = np.array([0.5, 0.3, 0.2]) * n.sum()
    history = mixing.solve_rates(rows, targets)
    got = np.array([r["r"] for r in rows.select(mixing._rate(history, None).alias("r")).collect()])
    x = np.ones(400)
    for g in history:
        x = np.maximum(0.0, x - p @ g)
    assert np.allclose(got, x) and (got >= 0).all()
    assert np.abs((n * got) @ p - targets).max() <= 2e-3 * n.sum()


def test_mixture_totals(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_mixing_to_target_weights"](spark, sf).toPandas()
    total = got.n_tokens.sum()
    for domain, share in (("good", 0.85), ("junk", 0.10), ("toxic", 0.05)):
        assert abs((got.n_tokens * got.rate * got[f"p_{domain}"]).sum() / total - share) < 5e-3
    assert abs((got.n_tokens * got.copies).sum() / total - 1) < 0.1
    assert (got.copies >= np.floor(got.rate)).all() and (got.copies <= np.floor(got.rate) + 1).all()


@pytest.mark.parametrize(("domains", "pull"), [(3, 0.5), (8, 1.0)])
def test_overlapping_posteriors_meet_their_targets(spark, domains, pull):
    rng = np.random.default_rng(domains)
    z, own = rng.normal(size=(5_000, domains)), rng.integers(domains, size=5_000)
    z[np.arange(5_000), own] += pull
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    n = rng.integers(1, 1_000, size=5_000)
    rows = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(n, p)], ["n_tokens", *[f"p_{k}" for k in range(domains)]])
    targets = np.array([0.4, *[0.6 / (domains - 1)] * (domains - 1)]) * n.sum()
    rate = np.array([r["r"] for r in rows.select(mixing._rate(mixing.solve_rates(rows, targets), None).alias("r")).collect()])
    assert np.abs((n * rate) @ p / targets - 1).max() < 1e-3


def _local_sums(p, n, max_rate, passes):
    """``mixing._dual_sums`` on arrays."""
    def sums(duals, whole):
        out = []
        passes.append(len(duals))
        for x in duals:
            r = np.clip(1 - p @ x, 0, max_rate or np.inf)
            free = (r > 0) & (r < (max_rate or np.inf))
            out.append((0.5 * (n * (r - 1) ** 2).sum(), (n * r) @ p, (p[free] * n[free, None]).T @ p[free] if whole else None))
        return out

    return sums


def test_ordinary_targets_always_give_the_best_rates():
    """Posteriors and targets of many kinds, met or out of reach: the misses are the least there are, by the duality gap."""
    rng, far = np.random.default_rng(0), 0
    for _ in range(600):
        domains = int(rng.choice([2, 3, 3, 8]))
        z = rng.normal(size=(2_000, domains)) * rng.choice([0.3, 1, 3])
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        n, max_rate = rng.integers(1, 1_000, 2_000).astype(float), rng.choice([0, 1]) or None
        targets = rng.dirichlet([1] * domains) * n.sum() if rng.random() < 0.5 else (n @ p) * rng.choice([1, 0.11, 0.06, 0.5, 1.5, 3], domains)
        passes = []
        weight = 1 / (p * p * n[:, None]).sum(axis=0)
        x, totals = mixing.dual_newton(_local_sums(p, n, max_rate, passes), targets, weight)
        bend = mixing.SOFT[-1] / weight
        miss = totals - targets
        gap = 0.5 * (miss * miss / bend).sum() - x @ miss + 0.5 * (bend * x * x).sum()
        # The weighted misses differ from the least ones by the root of twice the gap at most.
        assert np.sqrt(max(0.0, 2 * gap * mixing.SOFT[-1]) / weight.min()) < 1e-4 * targets.sum()
        assert len(passes) < 120
        far += np.abs(miss).max() > 1e-3 * targets.sum()
    assert 100 < far < 500


def test_targets_that_used_to_fail(spark):
    """A rate of at most 1, the anchor met, the others at a fraction of what is there."""
    rng = np.random.default_rng(2)
    z = rng.normal(size=(2_000, 3)) * 3
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    n = rng.integers(1, 1_000, 2_000)
    rows = spark.createDataFrame([(int(t), *map(float, x)) for t, x in zip(n, p)], "n_tokens long, p_0 double, p_1 double, p_2 double")
    targets = (n @ p) * np.array([1, 0.11, 0.06])
    rate = np.array([r["r"] for r in rows.select(mixing._rate(mixing.solve_rates(rows, targets, 1.0), 1.0).alias("r")).collect()])
    assert rate.min() >= 0 and rate.max() <= 1
    slope = p @ (((n * rate) @ p - targets) / (p * p * n[:, None]).sum(axis=0))
    assert np.abs(slope[(rate > 1e-3) & (rate < 1 - 1e-3)]).max(initial=0) < 1e-4
    assert slope[rate == 0].min(initial=0) > -1e-4 and slope[rate == 1].max(initial=0) < 1e-4
    # One step is no fit, but rates all the same.
    assert len(mixing.solve_rates(rows, targets, 1.0, steps=1)) == 1


def test_pipeline_mixture_totals(spark):
    """The rates of the pipeline's mixing stage are the least-squares optimum, and misses are told."""
    docs = corpus_pipeline.toxicity(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "/root/testdata/sf0.01")
    labels = mixing.quality_domains(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    got = mixing.mixing_rates(docs, labels, MIX, max_rate=1.0, anchor="good", left_out=("toxic",)).toPandas()
    p, n, r = got[["p_good", "p_junk"]].to_numpy(), got.n_tokens.to_numpy(dtype=float), got.rate.to_numpy()
    total = (n * p[:, 0]).sum() / (0.85 / 0.95)
    targets = np.array([0.85, 0.10]) / 0.95 * total
    left = (n * r) @ p - targets
    assert np.allclose(got[["missed_good", "missed_junk"]].iloc[0], left / targets, atol=1e-6) and "missed_toxic" not in got
    # Good is met; junk, of which there is too little and nothing may be repeated, is there as a whole.
    assert abs(left[0] / targets[0]) < 1e-6 and left[1] < 0 and np.allclose(r, 1)
    assert r.min() >= 0 and r.max() <= 1
    # Where a rate isn't at a bound the gradient is 0, at a bound it points outward.
    weight = 1 / ((p * p) * n[:, None]).sum(axis=0)
    slope = p @ (weight * left)
    assert np.abs(slope[(r > 1e-6) & (r < 1 - 1e-6)]).max(initial=0) < 1e-4
    assert slope[r == 0].min(initial=0) > -1e-4 and slope[r == 1].max(initial=0) < 1e-4


def test_one_row_of_each_simhash_group_stays(spark):
    a, b = "one two three four five", "a wholly different text of six or more words"
    rows = [(1, a, "en", "x"), (2, b, "en", "x"), (2, a, "en", "x"), (3, b, "en", "x"), (3, b, "en", "x"), (None, a, "en", "x"), (None, "null ids alone stay once", "en", "x"),
            (None, "null ids alone stay once", "en", "x"), (4, None, None, None), (5, "", None, None)]
    df = frame(spark, rows).withColumn("fp", F.lit("mine")).withColumn("component_id", F.lit(0))
    got = simhash.keep_first_of_group(df, 3, 2)
    assert got.columns == df.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (None, "null ids alone stay once"), (4, None)], key=repr)


# -- all ---------------------------------------------------------------------
LABELS = "doc_id long, quality int, toxic int"


def everything(spark, df):
    """Each operator on documents ``df``, as a name -> row count."""
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (4, None, None)], LABELS)
    made = {
        "1": fingerprints.document_fingerprints(df), "2": toxicity.toxicity_scores(df, labels), "3": licenses.license_scan(df),
        "4": sharding.shard_digest(df), "5": pieces.piece_digest(df), "7": linededup.dedup_lines(df),
        "9": simhash.simhash_digest(df, 3, 2), "10": mixing.mixing_rates(df, mixing.quality_domains(labels), {"good": 1.0}),
    }
    return {k: v.count() for k, v in made.items()}


def test_odd_documents_everywhere(spark):
    odd = odd_documents(spark)
    n = odd.count()
    assert everything(spark, odd) == {k: n for k in ("1", "2", "3", "4", "5", "7", "9", "10")}


def test_empty_tables_everywhere(spark):
    none = odd_documents(spark).limit(0)
    assert set(everything(spark, none).values()) == {0}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.vector_digest(empty).count() == 0


def test_pipeline_by_stage(spark, docs):
    """Each stage against its own input, by plain means."""
    made, read = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        read = corpus_pipeline.cut(stage(spark, read, SF), "test-stage")
        made[name] = read
    assert all(made[n].columns == docs.columns for n, _ in corpus_pipeline.STAGES[:-1])
    rows = {n: {r["doc_id"]: r for r in df.collect()} for n, df in made.items()}
    given = {r["doc_id"]: r for r in docs.collect()}
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert set(rows["toxicity"]) == {i for i in given if not scores[i]}
    lines = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(made["toxicity"]).collect()}
    assert {i: r["text"] for i, r in rows["line_dedup"].items()} == lines
    prints = {i: _simhash(t, 3) for i, t in lines.items()}
    low = {i: i for i in prints}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    for _ in prints:
        for a, b in near:
            low[a] = low[b] = min(low[a], low[b])
    assert set(rows["simhash_near_dedup"]) == {i for i, x in low.items() if x == i}
    assert set(rows["mixing"]) <= set(rows["simhash_near_dedup"]) and len(rows["mixing"]) == made["mixing"].count()
    assert set(rows["sentencepiece"]) == set(rows["mixing"]) and all(r["lossless"] for r in rows["sentencepiece"].values())


def _pipeline_input(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_pipeline_on_odd_documents(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated ids and rows, extra columns with clashing names."""
    odd = odd_documents(spark).withColumn("n_removed", F.lit(7)).withColumn("gone", F.lit("g"))
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, 0, 1), (None, 1, 1), (7, None, None)], LABELS)
    sf = _pipeline_input(spark, tmp_path, odd, labels)
    read = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        read = corpus_pipeline.cut(stage(spark, read, sf), "test-odd")
        assert read.columns == odd.columns, name
        assert {(r["n_removed"], r["gone"], r["key"]) for r in read.collect()} <= {(7, "g", "k")}, name
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) == read.count() > 0 and all(r["lossless"] for r in got)


def test_pipeline_on_no_rows(spark, tmp_path):
    sf = _pipeline_input(spark, tmp_path, odd_documents(spark).limit(0), spark.createDataFrame([], LABELS))
    assert corpus_pipeline.run(spark, sf).count() == 0
