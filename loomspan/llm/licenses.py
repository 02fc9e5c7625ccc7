"""Licence scans: phrases and whole notices in every text, by diagonal voting.

Every run of k words of a document is hashed and joined with the runs of the notices. A hit
votes for a diagonal, the document's place less the notice's. Neighbouring diagonals, which
an inserted or lost word sets apart, are merged, and each span is verified word by word.
All work is on built-in expressions.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Labels and customary wordings of their notices.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

#: Characters that stand between words.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class ScanConfig:
    """Runs of `k` words vote. Diagonals at most `shift` apart are one span. Spans whose votes are at
    least `least_votes` of the notice's runs are verified; one is a notice if `least_words`
    of its words stand on the span's diagonals."""

    k: int = 3
    shift: int = 4
    least_votes: float = 0.4
    least_words: float = 0.75


def normal(text: Column) -> Column:
    """Words in lower case (A-Z only) with one space between; null is empty."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), BREAKS, " "))


def _words(norm: Column) -> Column:
    return F.when(norm != "", F.split(norm, " ")).otherwise(F.array().cast("array<string>"))


def split_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, norm, words) of docs. Each step is a generated column, which later filters refer to
    and do not compute again, for every word of a text at worst."""
    norm = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode_outer(F.array(normal(F.col("text")))).alias("norm"))
    return norm.select("*", F.explode_outer(F.array(_words(F.col("norm")))).alias("words"))


def places(words: Column, norm: Column, phrase: str) -> Column:
    """Starts of a phrase's words in `words`, an attribute; found by search in `norm` first."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    same = lambda i: F.forall(F.sequence(F.lit(0), F.lit(len(parts) - 1)), lambda j: F.get(words, i + j) == F.get(F.lit(parts), j))
    at_first = lambda i: (F.get(words, i) == parts[0]) & same(i)
    held = F.contains(F.concat(F.lit(" "), norm, F.lit(" ")), F.lit(f" {phrase} "))
    return F.when(held, F.filter(F.sequence(F.lit(0), last), at_first)).otherwise(F.array().cast("array<int>"))


def base_figures(docs: DataFrame, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(doc_id, text_key, n_words, n_base, first_word, last_word, found): `found` are the labels of phrases."""
    at = split_texts(docs).select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), *(places(F.col("words"), F.col("norm"), p).alias(f"p{i}") for i, p in enumerate(phrases)))
    every = F.concat(*(F.col(f"p{i}") for i in range(len(phrases))))
    found = F.array_compact(F.array(*(F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values()))))
    return at.select(
        "doc_id", "text_key", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_distinct(found).alias("found")
    )


def _runs(words: Column, k: int) -> Column:
    """Hashes of the runs of k words of `words`, an attribute."""
    last = F.size(words) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k))))).otherwise(F.array().cast("array<bigint>"))


def notice_table(spark: SparkSession, notices: Sequence[tuple[str, str]]) -> DataFrame:
    """(notice, label, words) of the notices, numbered."""
    rows = [(i, label, text) for i, (label, text) in enumerate(notices)]
    return spark.createDataFrame(rows, "notice int, label string, text string").select("notice", "label", _words(normal(F.col("text"))).alias("notice_words"))


def spans(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, config: ScanConfig = ScanConfig()) -> DataFrame:
    """(doc_id, text_key, notice, label, start, end, share): verified spans of notices, in words from 0; `share` of
    the notice's words stand on the span's diagonals. Repeated rows give each span once.

    The notices are a parameter, which bounds what is broadcast.
    """
    spark = docs.sparkSession
    known = notice_table(spark, notices)
    grams = known.select("notice", F.posexplode(_runs(F.col("notice_words"), config.k)).alias("at", "run"))
    hashed = split_texts(docs).withColumn("runs", _runs(F.col("words"), config.k))
    hits = hashed.select("doc_id", "text_key", F.posexplode_outer("runs").alias("pos", "run")).join(F.broadcast(grams), "run")
    by = ["doc_id", "text_key", "notice"]
    diagonals = hits.groupBy(*by, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count_distinct("pos").alias("votes"))
    order = Window.partitionBy(*by).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > config.shift).cast("int"), F.lit(1))
    merged = diagonals.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order)).groupBy(*by, "span").agg(F.sum("votes").alias("votes"), F.array_sort(F.collect_list("diagonal")).alias("diagonals"))
    sizes = F.size("notice_words")
    likely = merged.join(F.broadcast(known), "notice").filter(F.col("votes") >= F.lit(config.least_votes) * (sizes - (config.k - 1)))
    # Only texts that hold some run of a notice travel to be verified.
    runs = [r.run for r in grams.select("run").distinct().collect()]
    texts = hashed.filter(F.arrays_overlap("runs", F.array(*(F.lit(r) for r in runs)).cast("array<bigint>"))).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "words").dropDuplicates(["d", "t"])
    both = likely.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
    here = lambda i: F.filter(F.col("diagonals"), lambda d: F.get(F.col("words"), i + d) == F.get(F.col("notice_words"), i))
    # The places, in the document, of the notice's words; of several the first.
    matched = F.filter(F.transform(F.sequence(F.lit(0), sizes - 1), lambda i: F.get(here(i), F.lit(0)) + i), lambda p: p.isNotNull())
    seen = both.select(*by, "label", sizes.alias("size"), matched.alias("matched"))
    share = F.size("matched") / F.col("size")
    return seen.select(*by, "label", F.array_min("matched").alias("start"), (F.array_max("matched") + 1).alias("end"), share.alias("share")).filter(F.col("share") >= config.least_words)


def scan(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, config: ScanConfig = ScanConfig(), phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs.

    Base figures are those of the phrases. `labels` adds the labels of verified notices; score is 1
    where a phrase stands, else the largest share of a notice's words found, else 0.

    A null or empty text has no words, no places and empty labels. Rows are judged by their text
    alone, so repeated rows and rows without a doc_id get equal results. Texts with fewer words
    than a run can hold phrases, but no notices. Other columns are not read.
    """
    by_text = spans(docs, notices, config).groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    base = base_figures(docs, phrases).join(by_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    every = F.array_union("found", F.coalesce("more", F.array().cast("array<string>")))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return base.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("found")).alias("base_labels"), joined(every).alias("labels"), F.round(score, 9).alias("score"))
