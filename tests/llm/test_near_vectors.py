"""Operator 8 on tight groups, large shards and large tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightshift.llm import vectors


def _frame(spark, v, labels=None):
    rows = [(i, [float(y) for y in x], 1 if labels is None else int(labels[i])) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "vec_id long, v array<double>, label int")


def _group(rng, size, width, noise):
    v = rng.normal(size=width) + rng.normal(size=(size, width)) * noise
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _near(v, threshold=0.98):
    near = v @ v.T >= threshold
    np.fill_diagonal(near, False)
    return near


def test_tight_group_over_many_shards_is_found_in_one_round(spark, monkeypatch):
    rng = np.random.default_rng(11)
    v = np.concatenate([_group(rng, 2_400, 32, 0.06), rng.normal(size=(600, 32))])
    made = vectors.distinct_vectors(_frame(spark, v))
    # Were the group dealt out among centroids of its own, links would be missed and all work done again.
    assert len(vectors.centroids(made)[1, 32]) < 8
    rounds, links = [], vectors.unit_links
    monkeypatch.setattr(vectors, "unit_links", lambda *a: rounds.append(1) or links(*a))
    counts, _ = vectors.near_vectors(_frame(spark, v))
    want = _near(v / np.linalg.norm(v, axis=1, keepdims=True)).sum()
    assert want > 1_000_000 and len(rounds) == 1
    assert counts.agg(F.sum("links")).first()[0] >= 0.99 * want


def test_audit_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(12)
    v = np.concatenate([_group(rng, 50, 16, 0.03), _group(rng, 3, 16, 0.01), rng.normal(size=(250, 16))])
    labels = np.arange(len(v)) % 2
    made = vectors.distinct_vectors(_frame(spark, v, labels)).cache()
    monkeypatch.setattr(vectors, "AUDIT_BLOCK", 40)
    monkeypatch.setattr(vectors, "AUDIT_ROWS", 7)
    monkeypatch.setattr(vectors, "AUDIT_LINKED", 10_000)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (_near(unit) & (labels[:, None] == labels)).sum(axis=1)
    got = {r["first"]: r["true"] for r in vectors.true_links(made, 0.98).join(made, "key").collect()}
    assert got == {i: n for i, n in enumerate(want.tolist()) if n}


def test_vectors_of_several_lengths_have_shards_of_their_own(spark):
    rng = np.random.default_rng(13)
    v = [*rng.normal(size=(2_000, 8)), *rng.normal(size=(2_000, 12))]
    made = vectors.distinct_vectors(_frame(spark, v)).cache()
    points = vectors.centroids(made)
    assert set(points) == {(1, 8), (1, 12)}
    shards = vectors.shard_members(made, points, 3).select(F.size("v").alias("w"), F.explode("shards").alias("s")).distinct().collect()
    assert {(r["w"], r["s"]) for r in shards} == {(w, s) for (_, w), c in points.items() for s in range(len(c))}


def _plain_greedy(sims, edges, start):
    """The law of the search: the best BEAM places met are all expanded, in rounds."""
    out = np.zeros(sims.shape, dtype=bool)
    for i in range(len(sims)):
        met, done = {start}, set()
        while todo := set(sorted(met, key=lambda p: -sims[i, p])[: vectors.BEAM]) - done:
            done |= todo
            met |= {int(q) for p in todo for q in np.flatnonzero(edges[p])}
        out[i, list(met)] = True
    return out


@pytest.mark.parametrize("beam", [3, 40])
def test_search_in_rounds_against_plain_sets(monkeypatch, beam):
    monkeypatch.setattr(vectors, "BEAM", beam)
    rng = np.random.default_rng(14)
    v = np.concatenate([_group(rng, 70, 12, 0.09), rng.normal(size=(130, 12))])
    v = vectors._unit(v[rng.permutation(200)])
    sims = (v @ v.T).astype(np.float32)
    near = vectors._robust_prune(sims.copy())
    edges = np.zeros((200, 200), dtype=bool)
    a, at = np.nonzero(near >= 0)
    edges[a, near[a, at]] = True
    assert not edges.diagonal().any() and (edges.sum(axis=1) <= vectors.DEGREE).all()
    tried = vectors._greedy(sims, edges, 17)
    assert (tried == _plain_greedy(sims, edges, 17)).all()
    some, found = vectors._in_range(v, edges, 0.98)
    whole = np.zeros((200, 200), dtype=bool)
    whole[np.ix_(some, some)] = found
    want, both = _near(v, 0.98 - 1e-5), edges | edges.T
    # Expansion from what is met, over edges of either way, only through places in range.
    for i in range(200):
        reach, front = set(), set(np.flatnonzero((both[i] | tried[i]) & want[i]).tolist())
        while front:
            reach |= front
            front = {int(q) for p in front for q in np.flatnonzero(both[p] & want[i])} - reach
        assert reach <= set(np.flatnonzero(whole[i]).tolist())
    assert not (whole & ~want).any() and (whole == whole.T).all()


def test_prune_keeps_what_no_kept_one_is_closer_to():
    rng = np.random.default_rng(15)
    v = vectors._unit(np.concatenate([_group(rng, 40, 6, 0.2), rng.normal(size=(60, 6))]))
    sims = (v @ v.T).astype(np.float32)
    got = vectors._robust_prune(sims.copy())
    for i in range(100):
        pool, kept = [p for p in np.argsort(-sims[i], kind="stable").tolist() if p != i][: vectors.CANDIDATES], []
        for p in pool:
            if len(kept) < vectors.DEGREE and all(vectors.ALPHA * (np.float32(1) - sims[k, p]) > np.float32(1) - sims[i, p] for k in kept):
                kept.append(p)
        assert [p for p in got[i].tolist() if p >= 0] == kept


def test_edges_take_part_of_the_key_for_the_name():
    keys = np.sort(np.array([5, 5 + 2**40, -7, 2**62 + 1], dtype=np.int64))
    names = vectors._short(np.array([-7, 2**62 + 1, 5, 99], dtype=np.int64))
    edges = vectors._edges(keys, np.array([5, -7]), np.array([2, 2]), names)
    place = {k: i for i, k in enumerate(keys.tolist())}
    ends = {k: set(np.flatnonzero(edges[i]).tolist()) for k, i in place.items()}
    assert ends[5] == {place[-7], place[2**62 + 1]} and not ends[5 + 2**40] and not ends[2**62 + 1]
    # Of two keys with one name either may be meant; 99 is no member.
    assert len(ends[-7]) == 1 and ends[-7] <= {place[5], place[5 + 2**40]}


def test_forest_of_a_long_chain():
    m = 50
    links = np.zeros((m, m), dtype=bool)
    order = np.random.default_rng(16).permutation(m - 5)
    links[order[:-1], order[1:]] = True
    assert vectors._forest(links | links.T).tolist() == [0] * (m - 5) + list(range(m - 5, m))
