"""License scans by diagonal voting, in DataFrame functions only.

Every run of ``RUN`` words of a text meets the places of the templates that
hold the same words, by a join on a hash of the run. A pair of places votes for
a diagonal, the text's place less the template's. A notice that stands whole
has all its votes on one diagonal; words put in or left out shift the rest to
neighbouring ones, so the votes of ``NEAR`` diagonals in a row are merged. A
span is verified by the share of the template's words that its votes, whose
words were compared one by one, cover.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, text_key

RUN = 3
NEAR = 8  # diagonals after the first that a span's votes may lie on
COVERED = 0.8  # share of a template's words that a span covers at least
MOST_BROADCAST = 100_000  # places of templates; beyond, Spark chooses the join
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A license's label, and a phrase or notice that names it; every whole place of a ``base`` phrase counts."""

    label: str
    text: str
    base: bool = False


# The base phrases, then sentences of well-known public notices.
BASE = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]
MORE = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-sa", "cc by sa"),
    Template("gpl", "gnu general public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]
TEMPLATES = BASE + MORE


def license_words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; none of a null one."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def word_runs(words: Column) -> Column:
    """An element (w0, w1, ...) for each word and those after it, nulls beyond the last."""
    whole = F.greatest(F.size(words), F.lit(1))
    return F.arrays_zip(*[F.slice(words, i + 1, whole).alias(f"w{i}") for i in range(RUN)])


def run_hash(run: str) -> Column:
    return F.xxhash64(*[F.col(f"{run}.w{i}") for i in range(RUN)])


def template_places(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(gram, own, template, place, size): every run of the templates' words, by its hash.

    A template of fewer than ``RUN`` words has no run and is refused.
    """
    short = [t.text for t in templates if len(t.text.split()) < RUN]
    if short:
        raise ValueError(f"a template needs {RUN} words: {short}")
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)])
    words = spark.range(1).select(F.inline(rows)).select("template", license_words(F.col("text")).alias("words"))
    runs = words.select("template", F.size("words").alias("size"), F.posexplode(word_runs(F.col("words"))).alias("place", "own"))
    runs = runs.where(F.col("place") <= F.col("size") - RUN).select(run_hash("own").alias("gram"), "own", "template", "place", "size")
    few = sum(len(t.text.split()) for t in templates) <= MOST_BROADCAST
    return F.broadcast(runs) if few else runs


def _met(docs: DataFrame, key: str, text: str, templates: Sequence[Template]) -> DataFrame:
    """One pass over the texts: a row for each text's last word, and one for each place that meets a template.

    (doc_id, hash, at, last, template, place, size), stored. ``at`` is the
    word's place; null if a text has no word.
    """
    rows = docs.select(F.col(key).alias("doc_id"), text_key(F.col(text)).alias("hash"), license_words(F.col(text)).alias("words"))
    every = rows.select("doc_id", "hash", F.posexplode_outer(word_runs(F.col("words"))).alias("at", "run"))
    every = every.withColumn("gram", run_hash("run")).withColumn("last", F.col("run.w1").isNull())
    same = [F.col(f"run.w{i}") == F.col(f"own.w{i}") for i in range(RUN)]
    places = template_places(docs.sparkSession, templates).withColumnRenamed("gram", "known")
    condition = F.col("gram") == F.col("known")
    for equal in same:
        condition = condition & equal
    met = every.join(places, condition, "left").where(F.col("last") | F.col("template").isNotNull())
    return stored(met.select("doc_id", "hash", "at", "last", "template", "place", "size"), "license-places")


def _votes(met: DataFrame) -> DataFrame:
    """(hash, template, size, diagonal, places): places of a template that meet a text on one diagonal.

    Each task first folds its own rows, so copies of one text cost a row a place.
    """
    one = met.where("template is not null").select("hash", "template", "size", (F.col("at") - F.col("place")).alias("diagonal"), "place").distinct()
    return one.groupBy("hash", "template", "size", "diagonal").agg(F.array_sort(F.collect_set("place")).alias("places"))


def _merged(votes: DataFrame) -> DataFrame:
    """(hash, template, diagonal, low, high, share): each diagonal with the votes of the ``NEAR`` after it.

    ``share`` of the template's words are covered, by words ``low`` up to
    ``high`` of the text. A frame holds ``NEAR`` + 1 diagonals at most, a
    partition one text's votes for one template.
    """
    frame = Window.partitionBy("hash", "template").orderBy("diagonal").rangeBetween(0, NEAR)
    covered = F.array_distinct(F.flatten(F.transform(F.flatten(F.collect_list("places").over(frame)), lambda p: F.sequence(p, p + (RUN - 1)))))
    return votes.select(
        "hash", "template", "diagonal",
        F.min(F.col("diagonal") + F.array_min("places")).over(frame).alias("low"),
        (F.max(F.col("diagonal") + F.array_max("places")).over(frame) + RUN).alias("high"),
        (F.size(covered) / F.col("size")).alias("share"),
    )


def _label(templates: Sequence[Template]) -> Column:
    return F.get(F.array(*[F.lit(t.label) for t in templates]), F.col("template"))


def license_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[Template] = tuple(TEMPLATES)) -> DataFrame:
    """(hash, label, start, end, share): verified spans of every distinct text, in words, ``end`` exclusive.

    ``hash`` is ``text_key`` of the text. Verified diagonals of one template no
    more than ``NEAR`` apart make one span.
    """
    found = _merged(_votes(_met(docs, key, text, templates))).where(F.col("share") >= COVERED)
    order = Window.partitionBy("hash", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True))
    runs = found.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(order))
    spans = runs.groupBy("hash", "template", "span").agg(F.min("low").alias("start"), F.max("high").alias("end"), F.max("share").alias("share"))
    return spans.select("hash", _label(templates).alias("label"), "start", "end", "share")


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[Template] = tuple(TEMPLATES)) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base`` counts the places where a base phrase stands whole, ``first_word``
    and ``last_word`` are the smallest and largest of them (null if none).
    ``labels`` are those of all templates of which ``COVERED`` of the words are
    covered, ``score`` the largest such share, 0 without a vote.

    A null or empty text has no words and no license. Rows that repeat come out
    each; copies of one text are voted on once. Any length of text; one row a
    word exists only inside a task. Other columns of ``docs``, whatever their
    names, take no part. An empty table gives no rows.
    """
    met = _met(docs, key, text, templates)
    votes = stored(_votes(met), "license-votes")
    base = [i for i, t in enumerate(templates) if t.base]
    whole = votes.where(F.col("template").isin(base) & (F.size("places") == F.col("size") - (RUN - 1)))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    phrases = whole.groupBy("hash").agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        listed(F.collect_set(_label(templates))).alias("base_labels"),
    )
    notices = _merged(votes).groupBy("hash").agg(
        listed(F.collect_set(F.when(F.col("share") >= COVERED, _label(templates)))).alias("labels"), F.max("share").alias("score")
    )
    # Written first: a join of two plain shuffles can split a text with very many copies.
    found = stored(notices.join(phrases, "hash", "left"), "license-texts")
    rows = met.where("last").select("doc_id", "hash", F.coalesce(F.col("at").cast("long") + 1, F.lit(0)).alias("n_words"))
    named = F.coalesce("base_labels", F.lit(""))
    return rows.join(found, "hash", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        named.alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
