"""Operator 2: toxicity by gradient-boosted trees over dense features.

A lexicon of words and word stems is learned from labelled rows (log-odds of
their document counts), the dense features of ``features.py`` describe every
whole text, boosted trees score them, and an isotonic curve turns tree
scores into probabilities.

Labelled rows are halved by a hash of their text: each half's features use
the lexicon learned on the other half, the trees learn on the first half and
the curve on the second, so neither step sees its own fit.  Scoring uses the
lexicon of both halves.  ``max_labelled`` bounds the labelled rows that are
learned from (a hash sample when there are more); everything else covers all
rows.  Copies of a text count once in learning, with their highest label.

Nulls and empties: null texts count as empty and are scored like any other;
labels that are null are not learned from.  Without both classes among the
labelled rows every document gets the share of toxic rows (0.5 without any).
Rows of the input that repeat are all returned; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightshift.llm.common import cut, text_of
from nightshift.llm.features import STEMS, features_udf

MAX_LABELLED = 12_000
LEXICON = 400
MIN_DOCUMENTS = 3
MIN_LOG_ODDS = 2.0
TREES = 20
DEPTH = 3
THRESHOLD = 0.3
#: Share of the uncalibrated score, which orders documents inside a flat step of the curve.
TIE_SHARE = 0.001


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``(text, label, half)`` of at most about ``bound`` labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.where(~held_out(F.col("doc_id")))
    n = known.count()
    if n > bound:
        step = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
        known = known.where(step < int(1_000_000 * bound / n))
    # The labelled rows are bounded by now, so the texts never move.
    texts = docs.select("doc_id", text_of(F.col("text")).alias("text")).join(F.broadcast(known), "doc_id")
    once = texts.groupBy("text").agg(F.max("label").cast("double").alias("label"))
    return cut(once.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")), "toxicity-labelled")


def learned_lexicon(rows: DataFrame, size: int) -> dict[str, float]:
    """At most ``size`` words and stems (``stem*``) that mark label 1, with their log-odds.

    A stem must bring documents that no chosen longer entry explains better;
    entries are ranked by log-odds times the root of their document count.
    """
    words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", "")))
    terms = F.array_distinct(F.concat(F.col("words"), *[
        F.transform(F.filter("words", lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in STEMS
    ]))
    totals = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic = totals[0] or 0.0
    clean = (totals[1] or 0) - toxic
    if not toxic or not clean:
        return {}
    counts = (
        rows.select("label", words.alias("words")).select("label", F.explode(terms).alias("term"))
        .groupBy("term").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
        .where((F.col("a") >= max(MIN_DOCUMENTS, 0.005 * toxic)) & (F.length(F.regexp_replace("term", r"\*$", "")) >= 3))
    )
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    best = counts.select("term", odds.alias("w"), "a").where(F.col("w") >= MIN_LOG_ODDS)
    chosen = best.orderBy(F.desc(F.col("w") * F.sqrt("a")), "term").limit(size)
    return {r["term"]: float(r["w"]) for r in chosen.collect()}


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    base: float

    def score(self, df: DataFrame, text: Column, out: str = "score") -> DataFrame:
        """``df`` with the score of ``text`` in column ``out``."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.base))
        taken = set(df.columns)
        keep = [F.col(f"`{c}`") for c in df.columns if c != out]
        vec, own = _unused("__tox", taken), _unused("__tox_", taken)
        scored = df.withColumn(vec, array_to_vector(features_udf(self.lexicon)(text)))
        scored = _raw(self.trees, scored, vec, own)
        scored = self.curve.setFeaturesCol(own).setPredictionCol(f"{own}c").transform(scored)
        mixed = (1 - TIE_SHARE) * F.col(f"{own}c") + TIE_SHARE * F.col(own)
        return scored.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), mixed)).alias(out))


def _unused(name: str, taken: set[str]) -> str:
    while any(c.lower().startswith(name.lower()) for c in taken):
        name += "_"
    return name


def _raw(trees: GBTClassificationModel, df: DataFrame, vec: str, out: str) -> DataFrame:
    """The trees' probability of label 1, before calibration."""
    trees = trees.copy().setFeaturesCol(vec).setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"{out}p")
    return trees.transform(df).withColumn(out, vector_to_array(f"{out}p")[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    rows = labelled_sample(docs, labels, max_labelled)
    counts = {(r["half"], r["label"]): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    total = sum(counts.values())
    base = sum(n for (_, y), n in counts.items() if y == 1) / total if total else 0.5
    if any((half, y) not in counts for half in (0, 1) for y in (0.0, 1.0)):
        return ToxicityModel({}, None, None, base)
    halves = [rows.where(F.col("half") == h) for h in (0, 1)]
    lexicons = [learned_lexicon(half, LEXICON) for half in halves]
    described = [
        cut(half.select("label", features_udf(lexicons[1 - h])("text").alias("x")), "toxicity-features").select("label", array_to_vector("x").alias("x"))
        for h, half in enumerate(halves)
    ]
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(described[0].coalesce(4))
    raw = _raw(trees, described[1], "x", "raw")
    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw.select("raw", "label"))
    return ToxicityModel(learned_lexicon(rows, LEXICON), trees, curve, base)


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row; see the module docstring."""
    model = fit_toxicity(docs, labels, max_labelled)
    scored = model.score(docs.select("doc_id", F.col("text").cast("string").alias("text")), F.col("text"))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays under ``threshold``, with their columns."""
    model = fit_toxicity(docs, labels)
    score = _unused("__score", set(docs.columns))
    return model.score(docs, F.col("text"), score).where(F.col(score) < threshold).drop(score)
