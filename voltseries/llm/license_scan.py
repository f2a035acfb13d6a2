"""License scan by diagonal voting.

Templates are phrases and notices. All rolling pairs of words of every text are hashed
and joined to the positions of the same pairs in the templates. A hit votes for its
diagonal, the word of the text at which the template would start. Neighbouring diagonals
(words inserted or left out) are merged, and a merged span is kept if it covers enough of
the template and is not stretched. A base phrase counts at a diagonal that holds all its
pairs, which is a place where its words stand consecutively.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. Pair hashes
have 64 bits and are only compared with the few hundred pairs of the templates.

Defined cases: a null text is empty, with no words, labels or places and score 0; rows
that repeat id and text keep a row each; rows of one id with different texts, and null
ids, are scanned apart; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# Openings of public license notices and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        "mit",
    ),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        "gpl",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "bsd",
    ),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
)
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLACK = 3  # words that may be inserted or left out between merged diagonals
COVERAGE = 0.75  # share of a notice's pairs that a span must hold
MAX_WORDS = 60  # a template's pairs are bits of a long; cut longer texts into several
_MARK = -1  # hash and template of the entry that stands for the document itself


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    is_base: bool


def default_templates() -> list[Template]:
    base = [Template(tuple(p.split()), label, True) for p, label in BASE_PHRASES]
    return base + [Template(tuple(p.split()), label, False) for p, label in NOTICES]


def _lowered(text: Column) -> Column:
    """A-Z lower-cased. The Kelvin sign is the one other character with an ASCII lower case."""
    kelvin = "\u212a"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.contains(text, F.lit(kelvin)), F.translate(text, upper, lower)).otherwise(F.lower(text))


def scan_licenses(docs: DataFrame, templates: Sequence[Template] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return _per_document(spans(docs, templates))


def spans(docs: DataFrame, templates: Sequence[Template] | None = None) -> DataFrame:
    """The verified spans: doc_id, start_word, end_word, label, is_base, covered, …

    Every document also has one row without a label, which carries its number of words
    and how often it is repeated.
    """
    spark = docs.sparkSession
    templates = default_templates() if templates is None else list(templates)
    if any(not 2 <= len(t.words) <= MAX_WORDS for t in templates):
        raise ValueError(f"templates have 2 to {MAX_WORDS} words")
    pairs = [
        (no, at, t.words[at], t.words[at + 1]) for no, t in enumerate(templates) for at in range(len(t.words) - 1)
    ]
    grams = spark.createDataFrame(pairs, "template int, at int, first string, second string").select(
        F.xxhash64("first", "second").alias("gram"), "template", "at"
    )
    mark = spark.createDataFrame([(_MARK, _MARK, 0)], "gram long, template int, at int")
    about = spark.createDataFrame(
        [(no, t.label, t.is_base, len(t.words)) for no, t in enumerate(templates)],
        "template int, label string, is_base boolean, size int",
    )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(
        "doc_id", F.xxhash64(text).alias("_text"), F.regexp_extract_all(_lowered(text), F.lit(WORD), 0).alias("_words")
    )
    hashed = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1)))
    entries = words.select(
        "doc_id",
        "_text",
        F.size("_words").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit(_MARK).cast("bigint")), hashed)).alias("at_word", "gram"),
    )
    # The templates are arguments of the caller: a table of at most a few thousand pairs.
    hits = entries.join(F.broadcast(grams.unionByName(mark)), "gram")
    votes = hits.groupBy("doc_id", "_text", "n_words", "template", (F.col("at_word") - 1 - F.col("at")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, at))").alias("mask"),
        F.min("at_word").alias("low"),
        F.max("at_word").alias("high"),
        F.count(F.lit(1)).alias("n"),
    )

    one = Window.partitionBy("doc_id", "_text", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(one) > SLACK
    named = votes.join(F.broadcast(about), "template", "left")
    apart = F.when(F.col("is_base") | F.coalesce(far, F.lit(True)), 1).otherwise(0)
    runs = named.withColumn("_run", F.sum(apart).over(one))
    merged = runs.groupBy("doc_id", "_text", "n_words", "template", "label", "is_base", "size", "_run").agg(
        F.bit_or("mask").alias("mask"),
        F.min("diagonal").alias("diagonal"),
        (F.min("low") - 1).alias("start_word"),
        F.max("high").alias("end_word"),
        F.min("n").alias("n"),
    )
    covered = F.bit_count("mask") / (F.col("size") - 1)
    straight = F.col("end_word") - F.col("start_word") < F.col("size") * 1.5 + SLACK
    kept = F.when(F.col("is_base"), covered == 1).otherwise((covered >= COVERAGE) & straight)
    return merged.withColumn("covered", covered).filter(F.col("label").isNull() | kept)


def _per_document(found: DataFrame) -> DataFrame:
    place = F.when(F.col("is_base"), F.col("diagonal").cast("bigint"))

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    whole = found.groupBy("doc_id", "_text", "n_words").agg(
        F.count(place).alias("n_base"),
        F.min(place).alias("first_word"),
        F.max(place).alias("last_word"),
        joined(F.when(F.col("is_base"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("label").isNull(), F.col("n"))).cast("int").alias("_copies"),
    )
    return whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )
