"""Operator 8: embedding near-dedup over a robust-pruned flat graph.

Vectors are compared only when their labels are equal and not null, by
cosine in double precision; vectors that are null, empty, zero or hold null
or non-finite components link with nothing.  Equal vectors of a label
collapse to one with a multiplicity.

1. Shards: centroids are rows of a bounded hash sample (as many as the rows
   need, ``SHARD_ROWS`` each, at most ``MAX_CENTROIDS`` in all), without those
   within ``APART`` link angles of another, which would deal the members of
   one tight group out among themselves; every vector joins the shards of its
   ``overlap`` nearest centroids of its label.  A shard over ``BLOCK_ROWS``
   rows is cut into blocks, and every pair of its blocks is a unit of its own,
   so no task holds more than two blocks.
2. Build: each unit connects its vectors by robust pruning (a near neighbour
   is kept unless a kept one is closer to it by the factor ``ALPHA``).
3. Union: an edge goes to every unit that holds both its ends, where a
   vector's adjacency lists of all its units are joined to one; edges lead
   both ways when ranges are expanded.
4. Search: in each unit, every vector is searched greedily from the medoid
   with a list of ``BEAM``, whose open entries are all expanded in one round;
   from itself and whatever it found in range, the search then expands through
   neighbours in range until none is new.
5. Verify: a link counts only with a double-precision cosine of at least the
   threshold.  Of the units that hold both ends, the smallest counts it for
   both, so counts need no list of pairs; components come from the spanning
   forest of each unit's links.
6. Audit: the vectors with a vec_id divisible by 50 are compared with all rows
   of their label by brute force, block by block; with fewer than ``AUDIT_LINKED``
   linked ones among them those divisible by 10 too, then all.  Recall is a
   mean over the queries that have links, and over those of each group size;
   while the lowest stays under ``RECALL`` the overlap is doubled, and a
   recall under ``LEAST_RECALL`` in the end raises.

Nulls and ties: a null vec_id takes part under its own row with component
null; rows with the same vec_id and vector are copies of each other; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from nightshift.llm.common import cut
from nightshift.llm.components import connected_components

THRESHOLD = 0.98
SHARD_ROWS = 300
MAX_CENTROIDS = 65_536
APART = 1.5
BLOCK_ROWS = 1_500
OVERLAP = 3
DEGREE = 20
CANDIDATES = 60
ALPHA = 1.2
BEAM = 40
RECALL, LEAST_RECALL = 0.95, 0.9
#: The audit's queries have vec_ids divisible by the first; the next follow while fewer than ``AUDIT_LINKED`` have links.
AUDIT_STEPS = (50, 10, 1)
AUDIT_LINKED = 20
#: Rows of a block of the audit's comparison, and of the tiles in it.
AUDIT_BLOCK = 32_768
AUDIT_ROWS = 1_000


def _usable(df: DataFrame):
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``(key, label, v, n, first, asked)``: different vectors of a label with their count, smallest id and audit step."""
    good = rows.where(_usable(rows))
    last = len(AUDIT_STEPS) - 1
    asked = F.lit(last)
    for k in reversed(range(last)):
        asked = F.when(F.pmod("vec_id", F.lit(AUDIT_STEPS[k])) == 0, F.lit(k)).otherwise(asked)
    one = good.withColumn("v", _unsigned_zero(rows)).groupBy("label", "v").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.min(asked).alias("asked"))
    return one.withColumn("key", F.xxhash64("label", "v"))


def _unsigned_zero(rows: DataFrame):
    """Zero has two signs; they are one vector."""
    zero = F.lit(0.0).cast(rows.schema["v"].dataType.elementType)
    return F.transform("v", lambda x: F.when(x == 0, zero).otherwise(x))


def centroids(vectors: DataFrame, threshold: float = THRESHOLD) -> dict:
    """(label, width) -> matrix of unit centroids: rows of a bounded hash sample, none close to another."""
    counts = vectors.groupBy().count().first()[0]
    if not counts:
        return {}
    wanted = min(MAX_CENTROIDS, counts // SHARD_ROWS + 1)
    share = min(1.0, wanted / counts)
    step = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1_000_000_000))
    picked = vectors.where(step < int(share * 1_000_000_000)).select("label", "v").limit(2 * MAX_CENTROIDS).toArrow()
    widths = picked["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    places: dict = {}
    for i, kind in enumerate(zip(picked["label"].to_pylist(), widths.tolist())):
        places.setdefault(kind, []).append(i)
    # Vectors of different lengths can't be compared: the length is part of the label.
    return {kind: _apart(_unit(_matrix(picked["v"].take(pa.array(at)))).astype(np.float32), threshold) for kind, at in places.items()}


def _apart(v: np.ndarray, threshold: float) -> np.ndarray:
    """Of unit rows ``v`` those that no kept earlier one is within ``APART`` link angles of."""
    close = np.cos(min(np.pi, APART * np.arccos(min(1.0, threshold))))
    alive = np.ones(len(v), dtype=bool)
    step = 128
    for at in range(0, len(v), step):
        rows, end = np.arange(at, min(len(v), at + step)), at + step
        before = np.flatnonzero(alive[:at])
        alive[rows] = ~(v[rows] @ v[before].T >= close).any(axis=1)
        near = v[rows] @ v[rows].T >= close
        for k, i in enumerate(rows):
            if alive[i]:
                alive[i + 1 : end] &= ~near[k, k + 1 :]
    return v[alive]


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _matrix(lists) -> np.ndarray:
    """An Arrow column of lists of one length, in double precision."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def shard_members(vectors: DataFrame, points: dict, overlap: int) -> DataFrame:
    """``vectors`` with their ``shards`` (nearest first): places of centroids of their label."""

    @F.arrow_udf("array<int>")
    def nearest(labels: pa.Array, vs: pa.Array) -> pa.Array:
        kinds, which = np.unique(vs.value_lengths().to_numpy(zero_copy_only=False), return_inverse=True)
        coded = labels.dictionary_encode()
        which = which * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
        found: list = [[0]] * len(vs)
        for kind in np.unique(which).tolist():
            width, label = kinds[kind // len(coded.dictionary)], coded.dictionary[kind % len(coded.dictionary)].as_py()
            centres = points.get((label, int(width)))
            if centres is None:
                continue
            at = np.flatnonzero(which == kind)
            score = _unit(_matrix(vs.take(pa.array(at)))).astype(np.float32) @ centres.T
            near = np.empty((len(at), min(overlap, len(centres))), dtype=np.int32)
            for k in range(near.shape[1]):
                near[:, k] = score.argmax(axis=1)
                score[np.arange(len(at)), near[:, k]] = -np.inf
            for i, row in zip(at.tolist(), near.tolist()):
                found[i] = row
        return pa.array(found, pa.list_(pa.int32()))

    return vectors.withColumn("shards", nearest("label", "v"))


def oversize(members: DataFrame) -> DataFrame:
    """``(label, width, shard, blocks)`` of the shards over ``BLOCK_ROWS`` rows."""
    each = members.select("label", F.size("v").alias("width"), F.explode("shards").alias("shard"))
    size = each.groupBy("label", "width", "shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    return size.where("blocks > 1")


UNIT = ["label", "width", "shard", "i", "j"]


def units(members: DataFrame, large: DataFrame) -> DataFrame:
    """``(unit, block, key, v, n, shards)`` rows: every member in every unit of its shards."""
    each = members.select("label", F.size("v").alias("width"), F.explode("shards").alias("shard"), "key", "v", "n", "shards")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod("key", blocks).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda b: F.struct(F.least(block, b).alias("i"), F.greatest(block, b).alias("j")),
    )
    dealt = each.join(large, ["label", "width", "shard"], "left").withColumn("block", block).withColumn("pair", F.explode(others))
    return dealt.select("label", "width", "shard", "pair.i", "pair.j", "block", "key", "v", "n", "shards")


def _nearest(sims: np.ndarray, count: int) -> np.ndarray:
    """For each row of a similarity matrix the places of its ``count`` largest entries, largest first."""
    m = sims.shape[1]
    near = np.argpartition(sims, m - count, axis=1)[:, m - count :]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1), axis=1)


def _robust_prune(sims: np.ndarray) -> np.ndarray:
    """For each row of a unit's similarity matrix, the places of its kept neighbours, then -1.  Its diagonal is lost."""
    m = len(sims)
    take = min(CANDIDATES, m - 1)
    if take <= 0:
        return np.full((m, 1), -1, dtype=np.int64)
    np.fill_diagonal(sims, -2.0)
    near = _nearest(sims, take)
    mine = 1.0 - np.take_along_axis(sims, near, axis=1)
    alive, count = np.ones((m, take), dtype=bool), np.zeros(m, dtype=np.int64)
    out = np.full((m, min(DEGREE, take)), -1, dtype=np.int64)
    flat = sims.ravel()
    for a in range(take):
        rows = np.flatnonzero(alive[:, a] & (count < DEGREE))
        if len(rows):
            kept = near[rows, a]
            out[rows, count[rows]] = kept
            count[rows] += 1
            among = 1.0 - flat[kept[:, None] * m + near[rows, a + 1 :]]
            alive[rows, a + 1 :] &= ALPHA * among > mine[rows, a + 1 :]
        elif (count == DEGREE).all():
            break
    return out


def _shards_of(table: pa.Table) -> np.ndarray:
    """The shards of a unit's rows, which have equally many."""
    lists = table["shards"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _short(keys: np.ndarray) -> np.ndarray:
    """Names of vectors in adjacency lists: half of the key, as wrong edges cost a comparison only."""
    return keys.astype(np.int32)


def build_graph(placed: DataFrame, large: DataFrame) -> DataFrame:
    """``(unit, key, near)``: every vector's adjacency lists of all its units, in each of them the neighbours that it holds."""
    types = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in UNIT) + ", key long, near array<int>"
    # Fewer than one for each BLOCK_ROWS rows that are dealt.
    blocks = {(r["label"], r["width"], r["shard"]): r["blocks"] for r in large.collect()}

    def build(unit: tuple, table: pa.Table) -> pa.Table:
        label, width = unit[0].as_py(), unit[1].as_py()
        keys, shards = table["key"].to_numpy(), _shards_of(table)
        v = _unit(_matrix(table["v"])).astype(np.float32)
        near = _robust_prune(v @ v.T)
        a, at = np.nonzero(near >= 0)
        b = near[a, at]
        parts = []
        for t in range(shards.shape[1]):
            s = shards[a, t]
            both = (shards[b] == s[:, None]).any(axis=1)
            parts.append((s[both], a[both], b[both]))
        shard, a, b = (np.concatenate(x) for x in zip(*parts))
        known, which = np.unique(shard, return_inverse=True)
        count = np.array([blocks.get((label, width, s), 1) for s in known.tolist()], dtype=np.int64)[which]
        i, j = np.mod(keys[a], count), np.mod(keys[b], count)
        # Two vectors of one block are together in all of its pairs, others in one pair.
        times = np.where(i == j, count, 1)
        row = np.repeat(np.arange(len(a)), times)
        other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        shard, a, b, i, j = shard[row], a[row], b[row], i[row], np.where(i[row] == j[row], other, j[row])
        i, j = np.minimum(i, j), np.maximum(i, j)
        order = np.lexsort((a, j, i, shard))
        shard, a, b, i, j = shard[order], a[order], b[order], i[order], j[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (shard[1:] != shard[:-1]) | (a[1:] != a[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(a)).astype(np.int32)), pa.array(_short(keys)[b]))
        same = [pa.repeat(x, len(starts)) for x in unit[:2]]
        places = [pa.array(x[starts].astype(np.int32)) for x in (shard, i, j)]
        return pa.Table.from_arrays([*same, *places, pa.array(keys[a[starts]]), lists], names=[*UNIT, "key", "near"])

    return placed.groupBy(*UNIT).applyInArrow(build, schema)


def _open(sims: np.ndarray, nearest: np.ndarray, tried: np.ndarray, done: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, place)``, by row: what isn't ``done`` of the ``BEAM`` best ``tried`` places of each of ``rows``."""
    mine = nearest[rows]
    met = tried[rows[:, None], mine]
    # Where the nearest places of all hold enough tried ones, these are the best.
    enough = met.sum(axis=1) >= min(BEAM, len(sims))
    sure = np.flatnonzero(enough)
    met, mine = met[sure], mine[sure]
    at, k = np.nonzero(met & (met.cumsum(axis=1, dtype=np.int16) <= BEAM))
    row, place = [rows[sure[at]]], [mine[at, k]]
    if len(sure) < len(rows):
        rest = rows[~enough]
        some = np.flatnonzero(tried[rest].any(axis=0))
        score = np.where(tried[np.ix_(rest, some)], sims[np.ix_(rest, some)], np.float32(-np.inf))
        least = np.partition(score, len(some) - BEAM, axis=1)[:, len(some) - BEAM, None] if len(some) > BEAM else np.float32(-np.inf)
        at, k = np.nonzero((score >= least) & (score > -np.inf))
        row.append(rest[at])
        place.append(some[k])
    row, place = np.concatenate(row), np.concatenate(place)
    left = ~done[row, place]
    row, place = row[left], place[left]
    order = np.argsort(row, kind="stable")
    return row[order], place[order]


def _greedy(sims: np.ndarray, edges: np.ndarray, start: int) -> np.ndarray:
    """Which places every row meets by greedy search from ``start`` with a list of ``BEAM``, as a matrix."""
    m = len(sims)
    # Adjacency lists as bits, so that lists are joined by words.
    bits = np.packbits(np.pad(edges, ((0, 0), (0, -m % 64))), axis=1).view(np.uint64)
    nearest = _nearest(sims, min(m, 3 * BEAM))
    tried, done = np.zeros((m, m), dtype=bool), np.zeros((m, m), dtype=bool)
    tried[:, start] = True
    rows = np.arange(m)
    while True:
        row, place = _open(sims, nearest, tried, done, rows)
        if not len(row):
            return tried
        done[row, place] = True
        rows, first = np.unique(row, return_index=True)
        lists = np.bitwise_or.reduceat(bits[place], first, axis=0)
        tried[rows] |= np.unpackbits(lists.view(np.uint8), axis=1, count=m).view(bool)


def _edges(keys: np.ndarray, owners: np.ndarray, lengths: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The edges between a unit's sorted ``keys`` as a matrix, from lists of so many ``names`` (short keys) of their ``owners`` (keys)."""
    m, short = len(keys), _short(keys)
    order = np.argsort(short, kind="stable")
    a = np.repeat(np.searchsorted(keys, owners), lengths)
    b = order[np.minimum(np.searchsorted(short[order], names), m - 1)]
    known = (short[b] == names) & (a != b)
    edges = np.zeros((m, m), dtype=bool)
    edges[a[known], b[known]] = True
    return edges


def _in_range(v: np.ndarray, edges: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The places of a unit that have links, and the links as a symmetric matrix: greedy search, then range expansion."""
    wide = v.astype(np.float32)
    sims = wide @ wide.T
    medoid = int((wide @ wide.mean(axis=0)).argmax())
    tried = _greedy(sims, edges, medoid)
    # Single precision only proposes: a margin over its rounding error.
    near = sims >= threshold - max(1e-5, (v.shape[1] + 8) * 2.0**-23)
    np.fill_diagonal(near, False)
    near |= near.T
    # Expansion never leaves the places that are in range of another.
    some = np.flatnonzero(near.any(axis=1))
    near = near[np.ix_(some, some)]
    # Pruning leaves the members of a tight group one way to its centre; the
    # way back from the centre has no cap.
    edges = edges[np.ix_(some, some)]
    edges = edges | edges.T
    found = near & (edges | tried[np.ix_(some, some)])
    step = edges.astype(np.float32)
    while True:
        found |= found.T
        open_ = np.flatnonzero((found != near).any(axis=1))
        new = near[open_] & ~found[open_] & (found[open_].astype(np.float32) @ step > 0)
        if not new.any():
            return some, found
        found[open_] |= new


def _verified(raw: np.ndarray, found: np.ndarray, threshold: float) -> np.ndarray:
    """``found`` without the pairs whose cosine in double precision is under the threshold."""
    unit = _unit(raw)
    sims = unit @ unit.T
    good = found & (sims >= threshold)
    # Near the threshold the order of the steps decides.
    a, b = np.nonzero(np.triu(found & (np.abs(sims - threshold) < 1e-12), 1))
    norm = np.sqrt((raw * raw).sum(axis=1))
    exact = np.concatenate([(raw[x] * raw[y]).sum(axis=1) / (norm[x] * norm[y]) for x, y in _parts(a, b)] or [np.empty(0)]) >= threshold
    good[a, b] = good[b, a] = exact
    return good


def unit_links(placed: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """``(key, links, root)`` per unit: links it counts for the vector, and its forest's root."""

    def search(unit: tuple, table: pa.Table, lists: pa.Table) -> pa.Table:
        shard, i, j = (x.as_py() for x in unit[2:])
        order = np.argsort(table["key"].to_numpy())
        keys, n, block = (table[c].to_numpy()[order] for c in ("key", "n", "block"))
        raw, shards = _matrix(table["v"])[order], _shards_of(table)[order]
        near = lists["near"].combine_chunks()
        lengths, names = (x.to_numpy(zero_copy_only=False) for x in (near.value_lengths(), near.flatten()))
        some, found = _in_range(_unit(raw), _edges(keys, lists["key"].to_numpy(), lengths, names), threshold)
        keys, n, block, raw, shards = keys[some], n[some], block[some], raw[some], shards[some]
        good = _verified(raw, found, threshold)
        # The smallest shard that holds both counts a link; within it the
        # unit of their blocks.
        lower, which = np.unique(shards, return_inverse=True)
        held = np.zeros((len(some), len(lower)), dtype=np.float32)
        held[np.arange(len(some))[:, None], which.reshape(shards.shape)] = 1
        held = held[:, lower < shard]
        own = good & ~(held @ held.T > 0)
        if i != j:
            own &= block[:, None] != block[None, :]
        links = (own @ n.astype(np.float64)).astype(np.int64)
        root = _forest(good)
        touched = (links > 0) | (root != np.arange(len(keys)))
        return pa.table({"key": keys[touched], "links": links[touched], "root": keys[root][touched]})

    joined = placed.groupBy(*UNIT).cogroup(graph.groupBy(*UNIT))
    return joined.applyInArrow(search, "key long, links long, root long")


def _parts(a: np.ndarray, b: np.ndarray, size: int = 1 << 16):
    return [(a[i : i + size], b[i : i + size]) for i in range(0, len(a), size)]


def _forest(links: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each place over a symmetric matrix of links."""
    m = len(links)
    root = np.arange(m)
    while m:
        low = np.minimum(root, np.where(links, root[None, :], m).min(axis=1))
        if (low == root).all():
            break
        root = low[low]
    return root


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, audit: bool = True, vectors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(key, links)`` and ``(key, component)`` of the different vectors that link at all; ``vectors``: those of ``rows``, where at hand."""
    if vectors is None:
        vectors = cut(distinct_vectors(rows), "vector-distinct")
    points = centroids(vectors, threshold)
    truth = true_links(vectors, threshold) if audit else None
    while True:
        members = shard_members(vectors, points, overlap)
        large = cut(oversize(members), "vector-large")
        placed = units(members, large)
        found = cut(unit_links(placed, build_graph(placed, large), threshold), "vector-links")
        counts = found.groupBy("key").agg(F.sum("links").alias("links"))
        recall = audit_recall(truth, counts) if audit else 1.0
        if recall >= RECALL:
            break
        if overlap >= max([1, *map(len, points.values())]):
            if recall < LEAST_RECALL:
                raise RuntimeError(f"recall of near vectors is {recall:.3f}, under {LEAST_RECALL}, with every shard searched")
            break
        overlap *= 2
    return counts, found.select("key", "root")


def _compared(vectors: DataFrame, step: int, threshold: float) -> DataFrame:
    """``(key, true)`` of the step's queries that have links, by comparing them with every row of their label."""
    asks = F.col("asked") == step
    kinds = vectors.groupBy("label", F.size("v").alias("width")).agg(
        F.ceil(F.count(F.lit(1)) / AUDIT_BLOCK).cast("int").alias("row_blocks"),
        F.ceil(F.count(F.when(asks, 1)) / AUDIT_BLOCK).cast("int").alias("query_blocks"),
    )
    kinds = cut(kinds.where("query_blocks > 0"), "vector-kinds")
    each = vectors.withColumn("width", F.size("v")).join(kinds, ["label", "width"])

    def dealt(mine: str, others: str) -> tuple:
        return F.pmod("key", mine).cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(others)

    rows = each.select("label", "width", *dealt("row_blocks", "query_blocks"), "key", "v", "n")
    queries = each.where(asks).select("label", "width", *dealt("query_blocks", "row_blocks"), "key", "v")
    # Names of its own, as both sides come from the same table.
    queries = queries.select([F.col(c).alias(f"asking_{c}") for c in queries.columns])
    # Away from the last digits, which differ from the search's.
    sure = threshold + 1e-12

    def near(table: pa.Table, asking: pa.Table) -> pa.Table:
        asked, keys = asking["asking_key"].to_numpy(), table["key"].to_numpy()
        true = np.zeros(len(asked), dtype=np.int64)
        if len(asked) and len(keys):
            q, v, n = _unit(_matrix(asking["asking_v"])), _unit(_matrix(table["v"])), table["n"].to_numpy()
            q_wide, wide = q.astype(np.float32), v.astype(np.float32)
            # Single precision only proposes: a margin over its rounding error.
            loose = sure - max(1e-5, (v.shape[1] + 8) * 2.0**-23)
            for at in range(0, len(asked), AUDIT_ROWS):
                for row in range(0, len(keys), AUDIT_ROWS):
                    hit = q_wide[at : at + AUDIT_ROWS] @ wide[row : row + AUDIT_ROWS].T >= loose
                    a, b = np.divmod(np.flatnonzero(hit.ravel()), hit.shape[1])
                    for x, y in _parts(a + at, b + row):
                        good = (asked[x] != keys[y]) & ((q[x] * v[y]).sum(axis=1) >= sure)
                        np.add.at(true, x[good], n[y[good]])
        return pa.table({"key": asked[true > 0], "true": true[true > 0]})

    by = ["label", "width", "row_blocks", "query_blocks"]
    found = rows.groupBy(*by).cogroup(queries.groupBy(*[f"asking_{c}" for c in by])).applyInArrow(near, "key long, true long")
    return found.groupBy("key").agg(F.sum("true").alias("true"))


def true_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """``(key, true)``: the audit's queries that have links to other vectors, with their number, by brute force."""
    truth = None
    for k in range(len(AUDIT_STEPS)):
        found = _compared(vectors, k, threshold)
        truth = cut(truth.unionByName(found) if truth is not None else found, "vector-truth")
        if truth.count() >= AUDIT_LINKED:
            break
    return truth


def audit_recall(truth: DataFrame, counts: DataFrame) -> float:
    """The lowest mean share of a query's true links that were counted: of all queries, and of each group size (by powers of 2) with enough of them."""
    share = F.least(F.lit(1.0), F.coalesce(F.col("links"), F.lit(0)) / F.col("true"))
    each = truth.join(counts, "key", "left").select(F.floor(F.log2("true")).alias("size"), share.alias("share"))
    sizes = [(r["n"], r["s"]) for r in each.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("s")).collect()]
    if not sizes:
        return 1.0
    return min([sum(s for _, s in sizes) / sum(n for n, _ in sizes), *[s / n for n, s in sizes if n >= AUDIT_LINKED]])


def vector_digest(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row; see the module docstring."""
    single = embeddings.schema["embedding"].dataType == ArrayType(FloatType(), True)
    v = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    vectors = cut(distinct_vectors(rows), "vector-distinct")
    counts, edges = near_vectors(rows, threshold, vectors=vectors)
    firsts = vectors.select("key", "first")
    ends = (
        edges.join(firsts, "key").withColumnRenamed("first", "a")
        .join(firsts.select(F.col("key").alias("root"), F.col("first").alias("b")), "root").select("a", "b")
    )
    found = connected_components(ends, "a", "b")
    named = (
        vectors.join(counts, "key", "left")
        .join(found, vectors["first"] == found["node"], "left")
        .select(F.col("key"), F.coalesce("component", "first").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("l"))
    )
    keyed = rows.select("vec_id", F.when(_usable(rows), F.xxhash64("label", _unsigned_zero(rows))).alias("k"))
    out = keyed.join(named, keyed["k"] == named["key"], "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("c"))
    return out.select(
        "vec_id", F.coalesce("l", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
