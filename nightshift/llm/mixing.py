"""Operator 10: mixing sources to target weights with soft memberships.

A classifier learned from a labelled table gives every document a posterior
over domains (multinomial logistic regression on the dense features of its
whole text).  The mixture's decision is a rate per document, the expected
number of its copies: rates in ``[0, max_rate]`` whose expected domain token
totals ``T_k = sum_d rate_d * tokens_d * p_dk`` match the targets in the
least-squares sense (each domain weighted by its inverse curvature), and of
those the nearest to rate 1 (by tokens).

That problem has K dual numbers l_k, and every rate follows from them alone:
``1 - sum_k p_dk l_k``, cut at 0 and ``max_rate``.  They are found by Newton's
method on the concave dual: one aggregation over narrow rows gives the K
totals and the K x K Gram matrix of the rates that aren't cut, a second one
tries shorter steps where the full step doesn't gain.  ``SOFT`` weighs the
distance from rate 1 against the misses; it is lowered in steps, so it
leaves next to nothing of targets that can be reached.  The fit ends when the
dual's gradient vanishes or no step gains any more.  A target that is still
missed is out of reach of any rates (together with the others):
``missed_<domain>`` tells by how much, as a share of its target, and a warning
is logged.  Domains in ``left_out``
(an earlier stage removed them) have no target: their total is free and the
other targets are shares among themselves.

``max_labelled`` bounds the labelled rows that are learned from (a hash
sample when there are more); totals and rates cover all rows.

Nulls and empties: null texts count as empty (no tokens: any rate fits; they
get what their posterior implies); labelled rows with a null id or domain
aren't learned from; without two labelled domains every document gets the
domains' shares (or equal ones) as posterior; rows that repeat are decided
alike; domains without a target get target 0, targets without labelled rows
stay unmet (``missed_<domain>`` -1); an empty table gives an empty result.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut, text_of
from nightshift.llm.features import features_udf

MAX_LABELLED = 12_000
#: Newton steps for each weight of ``SOFT``.
STEPS = 200
#: The dual's gradient at which a fit is done, and the miss from which a target counts as unmet; shares of all targets.
TOLERANCE, UNMET = 1e-7, 1e-3
#: Weights of the distance from rate 1, the last one holds.
SOFT = (1e-2, 1e-4, 1e-6, 1e-8)
TRIED = tuple(0.5**k for k in range(1, 13))
DAMPED = tuple(10.0**k for k in range(-6, 7))

LOG = logging.getLogger(__name__)


def quality_domains(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from the label table: toxic, else good or junk."""
    domain = F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality") == 1, F.lit("good")).when(F.col("quality") == 0, F.lit("junk"))
    return labels.select("doc_id", domain.alias("domain"))


@dataclass
class DomainModel:
    domains: list[str]
    shares: list[float]
    model: LogisticRegressionModel | None

    def describe(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, text_key, n_tokens, p_0, p_1, ...)`` per row of ``docs``."""
        text = text_of(F.col("text"))
        rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), features_udf({})(text).alias("x"))
        tokens = F.round(F.expm1(F.col("x")[0])).cast("long")
        if self.model is None:
            return rows.select("doc_id", "text_key", tokens.alias("n_tokens"), *[F.lit(s).alias(f"p_{k}") for k, s in enumerate(self.shares)])
        model = self.model.copy().setFeaturesCol("v").setRawPredictionCol("").setPredictionCol("").setProbabilityCol("p")
        scored = model.transform(rows.withColumn("v", array_to_vector("x"))).withColumn("p", vector_to_array("p"))
        return scored.select("doc_id", "text_key", tokens.alias("n_tokens"), *[F.col("p")[k].alias(f"p_{k}") for k in range(len(self.domains))])


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], max_labelled: int = MAX_LABELLED) -> DomainModel:
    """A posterior over ``domains`` and the labelled ones, from at most about ``max_labelled`` rows."""
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()).groupBy("doc_id").agg(F.max("domain").alias("domain"))
    n = known.count()
    if n > max_labelled:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < int(1_000_000 * max_labelled / n))
    # The labelled rows are bounded by now.
    texts = docs.select("doc_id", text_of(F.col("text")).alias("text")).join(F.broadcast(known), "doc_id")
    once = texts.groupBy("text").agg(F.max("domain").alias("domain"))
    rows = cut(once.select("domain", features_udf({})(F.col("text")).alias("x")), "mixing-labelled")
    counts = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    found = sorted(counts)
    if len(found) < 2:
        names = sorted({*domains, *found})
        total = sum(counts.values())
        return DomainModel(names, [counts.get(d, 0) / total if total else 1 / len(names) for d in names], None)
    index = reduce(lambda c, k: c.when(F.col("domain") == found[k], float(k)), range(1, len(found)), F.when(F.col("domain") == found[0], 0.0))
    model = LogisticRegression(featuresCol="v", labelCol="y", family="multinomial", regParam=0.003, maxIter=60).fit(
        rows.select(index.alias("y"), array_to_vector("x").alias("v")).coalesce(4)
    )
    return DomainModel(found, [], model)


def _posterior(k: int) -> Column:
    return F.col(f"p_{k}")


def _rate(history: list[np.ndarray], max_rate: float | None) -> Column:
    """The rate after all steps of ``history`` from 1; the dual numbers are one step."""
    rate = F.lit(1.0)
    for g in history:
        moved = rate - reduce(lambda a, b: a + b, [_posterior(k) * float(x) for k, x in enumerate(g)])
        rate = F.greatest(F.lit(0.0), moved)
        if max_rate is not None:
            rate = F.least(F.lit(float(max_rate)), rate)
    return rate


def _dual_sums(rows: DataFrame, many: range, max_rate: float | None, duals: list[np.ndarray], whole: bool) -> list[tuple]:
    """``(distance from rate 1, totals, Gram matrix of the free rates or None)`` at each of ``duals``, in one aggregation."""
    n, sums = F.col("n_tokens").cast("double"), []
    rates = [_rate([x], max_rate).alias(f"r_{t}") for t, x in enumerate(duals)]
    held = rows.select(n.alias("n"), *[_posterior(k) for k in many], *rates)
    for t in range(len(duals)):
        r, n = F.col(f"r_{t}"), F.col("n")
        sums += [F.sum(n * (r - 1) * (r - 1))] + [F.sum(n * r * _posterior(k)) for k in many]
        if whole:
            free = (r > 0) if max_rate is None else (r > 0) & (r < float(max_rate))
            sums += [F.sum(F.when(free, n * _posterior(i) * _posterior(j)).otherwise(0.0)) for i in many for j in many if i <= j]
    got = [x or 0.0 for x in held.agg(*[x.alias(f"s_{i}") for i, x in enumerate(sums)]).first()]
    k, out = len(many), []
    each = len(got) // len(duals)
    for t in range(len(duals)):
        mine = got[t * each : (t + 1) * each]
        gram = None
        if whole:
            gram = np.zeros((k, k))
            gram[np.triu_indices(k)] = mine[1 + k :]
            gram = gram + np.triu(gram, 1).T
        out.append((0.5 * mine[0], np.array(mine[1 : 1 + k]), gram))
    return out


def dual_newton(sums: Callable, targets: np.ndarray, weight: np.ndarray, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """The dual numbers and the totals they give; ``sums(duals, whole)`` is as ``_dual_sums``.

    A step is only taken if the dual gains by it.  Where the Newton step does
    not, shorter ones and ones with a damped Gram matrix (down to a short step
    along the gradient) are tried in one aggregation.  If none gains, the dual
    is at its maximum as far as the sums' precision tells, and that is the fit.
    """
    scale = max(targets.sum(), 1.0)
    x = np.zeros(len(targets))
    root = np.sqrt(weight)
    for soft in SOFT:
        bend = soft / weight

        def value(distance: float, totals: np.ndarray, at: np.ndarray) -> float:
            return distance + at @ (totals - targets) - 0.5 * (bend * at * at).sum()

        def move(gram: np.ndarray, left: np.ndarray, damp: float) -> np.ndarray:
            scaled = root[:, None] * (gram + np.diag(bend)) * root
            return root * np.linalg.solve(scaled + damp * np.eye(len(left)), root * left)

        distance, totals, gram = sums([x], True)[0]
        for _ in range(steps):
            left = totals - targets - bend * x
            if np.abs(left).max() <= tolerance * scale:
                break
            now = value(distance, totals, x)
            step = move(gram, left, 0.0)
            after = sums([x + step], True)[0]
            if value(after[0], after[1], x + step) < now + 1e-4 * (left @ step):
                tried = [x + s * step for s in TRIED] + [x + move(gram, left, d) for d in DAMPED]
                gains = [value(d, t, at) for at, (d, t, _) in zip(tried, sums(tried, False))]
                if not max(gains) > now + 1e-14 * abs(now):
                    break
                step = tried[int(np.argmax(gains))] - x
                after = sums([x + step], True)[0]
            x = x + step
            distance, totals, gram = after
    return x, totals


def fit_rates(rows: DataFrame, targets: np.ndarray, max_rate: float | None = None, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[list[np.ndarray], np.ndarray]:
    """The steps of ``_rate`` and the totals they give; ``targets`` are token totals by domain, nan where a domain has none."""
    n, has = F.col("n_tokens").cast("double"), np.flatnonzero(~np.isnan(targets))
    x = np.zeros(len(targets))
    every = range(len(targets))

    def sums(duals: list[np.ndarray], whole: bool) -> list[tuple]:
        full = []
        for d in duals:
            f = np.zeros(len(targets))
            f[has] = d
            full.append(f)
        return [(a, t[has], g[np.ix_(has, has)] if whole else None) for a, t, g in _dual_sums(rows, every, max_rate, full, whole)]

    if len(has):
        diagonal = rows.agg(*[F.sum(n * _posterior(int(k)) * _posterior(int(k))).alias(f"g_{k}") for k in has]).first()
        weight = 1.0 / np.maximum([g or 0.0 for g in diagonal], 1.0)
        x[has], _ = dual_newton(sums, targets[has], weight, steps, tolerance)
    return [x], _dual_sums(rows, every, max_rate, [x], False)[0][1]


def solve_rates(rows: DataFrame, targets: np.ndarray, max_rate: float | None = None, steps: int = STEPS, tolerance: float = TOLERANCE) -> list[np.ndarray]:
    """The steps of ``_rate`` that meet ``targets`` as nearly as rates can."""
    return fit_rates(rows, targets, max_rate, steps, tolerance)[0]


def mixing_rates(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rate: float | None = None, anchor: str | None = None, seed: int = 0, left_out: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, text_key, n_tokens, p_<domain>..., rate, copies, missed_<domain>...)`` per row of ``docs``.

    ``targets`` are shares of the total; the total is that of ``docs``, or
    what makes the target of domain ``anchor`` equal its present total.
    ``copies`` rounds the rate at random, by a hash of the row.
    """
    model = fit_domains(docs, labelled, sorted(targets))
    rows = cut(model.describe(docs), "mixing-posteriors")
    many = range(len(model.domains))
    sums = rows.agg(F.sum("n_tokens").alias("n"), *[F.sum(F.col("n_tokens") * _posterior(k)).alias(f"t_{k}") for k in many]).first()
    held = {d: float(t) for d, t in targets.items() if d not in left_out}
    shares = {d: t / max(sum(held.values()), 1e-12) for d, t in held.items()}
    here = {d: float(sums[f"t_{k}"] or 0.0) for k, d in enumerate(model.domains)}
    total = float(sums["n"] or 0) - sum(here.get(d, 0.0) for d in left_out)
    if anchor in here and shares.get(anchor):
        total = here[anchor] / shares[anchor]
    wanted = np.array([np.nan if d in left_out else shares.get(d, 0.0) * total for d in model.domains])
    history, got = fit_rates(rows, wanted, max_rate)
    missed = {d: -1.0 if total else 0.0 for d, t in shares.items() if t and d not in model.domains}
    missed |= {d: float(g / w - 1) for d, g, w in zip(model.domains, got, wanted) if w > 0}
    unmet = {d: m for d, m in missed.items() if abs(m) * shares[d] > UNMET}
    if unmet:
        LOG.warning("mixing: targets out of reach, missed by these shares of them: %s", unmet)
    rated = rows.withColumn("rate", _rate(history, max_rate))
    u = F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + F.when(u < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return rated.select(
        "doc_id", "text_key", "n_tokens", *[_posterior(k).alias(f"p_{d}") for k, d in enumerate(model.domains)], "rate", copies.cast("long").alias("copies"),
        *[F.lit(missed.get(d, 0.0)).alias(f"missed_{d}") for d in sorted(shares)],
    )


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rate: float | None = None, anchor: str | None = None, seed: int = 0, left_out: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs``, each as often as its ``copies`` say."""
    rates = mixing_rates(docs, labelled, targets, max_rate, anchor, seed, left_out)
    by = rates.groupBy(F.col("doc_id").alias("__d"), F.col("text_key").alias("__k")).agg(F.max("copies").cast("int").alias("__n")).where("__n > 0")
    key = F.xxhash64(text_of(F.col("text")))
    kept = docs.join(by, docs["doc_id"].eqNullSafe(by["__d"]) & (key == by["__k"]))
    return kept.withColumn("__n", F.explode(F.array_repeat(F.lit(1), F.col("__n")))).drop("__d", "__k", "__n")
