"""The corpus pipeline: documents through toxicity, line dedup, SimHash
near-dedup, mixing and SentencePiece, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshift.llm.common import cut, table
from nightshift.llm.linededup import dedup_lines
from nightshift.llm.mixing import mix, quality_domains
from nightshift.llm.pieces import piece_digest
from nightshift.llm.queries import MIX, SIMHASH_BITS, SIMHASH_WORDS
from nightshift.llm.simhash import keep_first_of_group
from nightshift.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # n_chars is a property of the text, which this stage changes.
    return dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_of_group(docs, SIMHASH_WORDS, SIMHASH_BITS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Good documents set the total, nothing is repeated; the toxicity stage has removed the toxic ones, so they have no target."""
    return mix(docs, quality_domains(table(spark, sf_dir, "labels")), MIX, max_rate=1.0, anchor="good", left_out=("toxic",))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_digest(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"pipeline-{name}")
    return docs


#: The stages' trained classifiers and sampled segmentations are outside SQL.
ORACLE_SQL = None
