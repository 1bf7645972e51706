"""License scan by diagonal voting.

Every rolling run of words of a text is joined by hash to the places where templates have it. Hits of one template
whose places in text and template differ by the same amount lie on a diagonal; a diagonal's hits are its votes,
neighbouring diagonals (a word more or less) are merged, and the spans with enough of the template are labelled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.rows import text_key

#: What separates words, and the phrases whose places are counted, with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
#: Wording of public licenses and notices, with the labels the method adds.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
#: Words of a run; shorter templates are one run.
RUN = 3
#: Diagonals so far apart at most are merged, if their spans are no further apart than a template is long.
DRIFT = 2
#: Share of a template's words that a span must hold for its label.
SHARE = 0.7
#: Templates of more words in all are joined by a shuffle, as nothing then bounds what would be broadcast.
BROADCAST_WORDS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def license_words(text: Column) -> Column:
    """Words with only A-Z lower-cased; empty for null texts."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    trimmed = F.regexp_replace(lowered, rf"^{SEPARATORS}|{SEPARATORS}\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATORS))


def _run(words: str, at: Column, length: int) -> Column:
    """Hash of `length` words from `at`; null beyond the end."""
    run = F.xxhash64(F.lit(length), *[F.get(F.col(words), at + j) for j in range(length)])
    return F.when(at + length <= F.size(words), run)


def _template_runs(spark, base, templates) -> tuple[DataFrame, list[int]]:
    """(h, run, template, label, is_base, size, place) for each run of each template, and the run lengths there are."""
    rows = [(k, label, k < len(base), words.split(" ")) for k, (label, words) in enumerate([*base, *templates])]
    lengths = sorted({min(RUN, len(r[3])) for r in rows})
    table = spark.createDataFrame(rows, "template int, label string, is_base boolean, words array<string>")
    placed = table.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("place"))
    run = F.least(F.lit(RUN), F.size("words"))
    h = F.coalesce(*[F.when(run == n, _run("words", F.col("place"), n)) for n in lengths])
    text = F.array_join(F.slice("words", F.col("place") + 1, run), " ")
    runs = placed.select(
        h.alias("h"), run.alias("run"), text.alias("run_text"), "template", "label", "is_base",
        F.size("words").alias("size"), "place",
    ).filter(F.col("h").isNotNull())
    return (F.broadcast(runs) if sum(len(r[3]) for r in rows) <= BROADCAST_WORDS else runs), lengths


def scan_licenses(
    documents: DataFrame, doc: str = "doc_id", text: str = "text",
    base: Sequence[tuple[str, str]] = BASE, templates: Sequence[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of `documents`.

    n_base counts the places where the words of a base phrase stand one after the other, first_word and last_word
    are the smallest and largest word, from 0, at which one starts, null if there is none. labels has the base labels
    found and those of templates of which a span holds `SHARE` of the words; both lists are distinct, sorted and
    joined by commas, empty if nothing is found. score is the largest share of any template or phrase found, else 0.
    A null or empty text has no words. Repeated rows and null ids are rows like any other. Every hit is compared word
    by word. Phrases and templates are given in lower case, their words split by single spaces.
    """
    spark = documents.sparkSession
    runs, lengths = _template_runs(spark, base, templates)
    rows = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("t")).select(
        "doc_id", text_key(F.col("t")).alias("key"), license_words(F.col("t")).alias("words")
    )
    at = F.col("at")
    rolled = rows.filter(F.size("words") > 0).select(
        "doc_id", "key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at")
    )
    hashed = rolled.select("doc_id", "key", "words", "at", F.explode(F.array(*[_run("words", at, n) for n in lengths])).alias("h"))
    hits = (
        hashed.join(runs, "h")
        .filter(F.array_join(F.slice("words", at + 1, F.col("run")), " ") == F.col("run_text"))
        .select("doc_id", "key", "at", "run", "template", "label", "is_base", "size", "place")
        .distinct()  # rows that repeat id and text vote once
    )
    diagonals = hits.groupBy("doc_id", "key", "template", "label", "is_base", "size", "run", (at - F.col("place")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("at").alias("start"), (F.max("at") + F.col("run")).alias("stop"),
        F.collect_list("place").alias("places"),
    )
    return _report(rows, diagonals)


def _report(rows: DataFrame, diagonals: DataFrame) -> DataFrame:
    """Merged and verified diagonals, reported for every row."""
    of = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(of) > DRIFT) | (
        F.col("start") - F.lag("stop").over(of) > F.col("size")
    )
    # A base phrase has to stand whole on one diagonal.
    opens = F.coalesce(apart | F.col("is_base"), F.lit(True)).cast("int")
    spans = (
        diagonals.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(of))
        .groupBy("doc_id", "key", "template", "label", "is_base", "size", "run", "span")
        .agg(F.flatten(F.collect_list("places")).alias("places"), F.min("start").alias("start"))
    )
    covered = F.size(
        F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("run") - 1))))
    )
    verified = spans.withColumn("share", covered / F.col("size")).filter(
        F.when(F.col("is_base"), F.col("share") == 1).otherwise(F.col("share") >= SHARE)
    )
    place = F.when(F.col("is_base"), F.col("start"))

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    found = verified.groupBy(F.col("doc_id").alias("f_id"), F.col("key").alias("f_key")).agg(
        F.count(place).alias("n_base"),
        F.min(place).cast("long").alias("first_word"),
        F.max(place).cast("long").alias("last_word"),
        joined(F.when(F.col("is_base"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    counted = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    return counted.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("key") == F.col("f_key")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
