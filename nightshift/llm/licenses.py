"""Operator 3: license scans by diagonal voting.

Every rolling pair of words of every whole text is hashed and joined with
the pairs of the templates (a fixed, broadcast table).  A hit at word p of
the text and pair t of a template votes for the diagonal p - t, that is for
the template starting at that word.  Votes are aggregated per (document,
template, diagonal) as bit masks of the template's pairs, one for every
``MASK_BITS`` of them, so only hits are shuffled, templates may be as long as
license texts are, and repeated rows change nothing.

Phrases (the base labels) need all their pairs on one diagonal, which means
their words stand consecutively from that word on.  For notices, diagonals
at most ``gap`` apart are merged (insertions and omissions shift the
diagonal) and a merged span is verified by the share of the template's pairs
it holds and by its length.  The joined words themselves are compared, so a
hash collision can't vote.

Nulls and empties: null texts count as empty (no words, no labels, score 0);
rows with a null or repeated doc_id are each returned with the result of
their own text; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from nightshift.llm.common import cut, lower_ascii, text_of
from nightshift.llm.license_texts import TEXTS

# Separators of words, phrases and notices with their labels,
# frequent words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under the creative commons attribution", "cc"),
    ("all rights reserved", "proprietary"),
)
FREQUENT = frozenset("a and are as at be by for from in is it of on or that the this to was with you".split())
GAP = 2
COVERAGE = 0.75
SLACK = 1.5
#: Pairs of a template that one mask holds.
MASK_BITS = 62


def templates() -> list[tuple[list[str], str, bool, list[tuple[int, str, str]]]]:
    """``(words, label, phrase, pairs)`` of each template; its voting pairs as (place, word, next word).

    Pairs of two frequent words don't vote in notices: they'd hit in any prose.
    """
    out = []
    for at, (text, label) in enumerate(PHRASES + NOTICES + TEXTS):
        words = [w for w in re.split(SEPARATORS, text.lower()) if w]
        phrase = at < len(PHRASES)
        pairs = [(t, a, b) for t, (a, b) in enumerate(zip(words, words[1:])) if phrase or not {a, b} <= FREQUENT]
        out.append((words, label, phrase, pairs))
    return out


def template_pairs(spark: SparkSession) -> DataFrame:
    """One row per voting pair of a template: as many as the fixed texts hold, about 1,300."""
    rows = []
    for at, (words, label, phrase, pairs) in enumerate(templates()):
        rows += [(at, label, phrase, len(words), len(pairs), t, t // MASK_BITS, 1 << t % MASK_BITS, a, b) for t, a, b in pairs]
    schema = "template int, label string, phrase boolean, length int, pairs int, t int, part int, bit long, a string, b string"
    return spark.createDataFrame(rows, schema).withColumn("h", F.xxhash64(F.concat_ws(" ", "a", "b")))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def _row_key() -> list[Column]:
    return [F.col("doc_id"), F.xxhash64("text").alias("text_key")]


def license_votes(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, template, ..., part, diagonal, mask, first_p, last_p)``: the votes of each diagonal and part of the template."""
    words = docs.select(*_row_key(), words_of(F.col("text")).alias("w")).where(F.size("w") > 1)
    pairs = F.arrays_zip(F.col("w").alias("x"), F.slice("w", 2, F.size("w")).alias("y"))
    rolled = words.select("doc_id", "text_key", F.posexplode(pairs).alias("p", "g")).select(
        "doc_id", "text_key", "p", "g.x", "g.y", F.xxhash64(F.lower(F.concat_ws(" ", "g.x", "g.y"))).alias("h")
    )
    templates = F.broadcast(template_pairs(docs.sparkSession))
    same = (lower_ascii(F.col("x")) == F.col("a")) & (lower_ascii(F.col("y")) == F.col("b"))
    hits = rolled.join(templates, "h").where(same)
    return hits.groupBy(
        "doc_id", "text_key", "template", "label", "phrase", "length", "pairs", "part", (F.col("p") - F.col("t")).alias("diagonal")
    ).agg(
        F.bit_or("bit").alias("mask"),
        F.min("p").alias("first_p"), F.max("p").alias("last_p"),
    )


def license_spans(votes: DataFrame) -> DataFrame:
    """Verified spans ``(doc_id, text_key, label, phrase, start, end, score)``, end exclusive, in words."""
    key = ["doc_id", "text_key", "template", "label", "phrase", "length", "pairs"]
    w = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    # A phrase's diagonals stay alone; a notice's neighbours merge, as do the parts of one diagonal.
    gap = F.col("diagonal") - F.lag("diagonal").over(w)
    new = gap.isNull() | (gap > F.when(F.col("phrase"), 0).otherwise(GAP))
    merged = (
        votes.withColumn("new", new.cast("int"))
        .withColumn("span", F.sum("new").over(w))
        .groupBy(*key, "span", "part")
        .agg(F.bit_or("mask").alias("mask"), F.min("first_p").alias("first_p"), F.max("last_p").alias("last_p"))
        .groupBy(*key, "span")
        .agg(F.sum(F.bit_count("mask")).alias("held"), F.min("first_p").alias("start"), (F.max("last_p") + 2).alias("end"))
    )
    score = F.col("held") / F.col("pairs")
    needed = F.when(F.col("phrase"), F.lit(1.0)).otherwise(F.lit(COVERAGE))
    fits = F.col("end") - F.col("start") <= SLACK * F.col("length") + GAP
    return merged.withColumn("score", score).where((F.col("score") >= needed) & fits).select(
        "doc_id", "text_key", "label", "phrase", "start", "end", "score"
    )


def _labels(which: Column) -> Column:
    return F.concat_ws(",", F.sort_array(F.collect_set(which)))


def license_scan(docs: DataFrame) -> DataFrame:
    """The digest per row of ``docs``; see the module docstring."""
    texts = docs.select("doc_id", text_of(F.col("text")).alias("text"))
    votes = cut(license_votes(texts), "license-votes")
    base = F.when(F.col("phrase"), F.col("start"))
    found = license_spans(votes).groupBy("doc_id", "text_key").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        _labels(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), _labels(F.col("label")).alias("labels"),
        F.max("score").alias("score"),
    ).select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = texts.select(*_row_key(), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["d"]) & (rows["text_key"] == found["k"]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
