"""Licence scan: exact phrases, and an exact set-similarity join of blocks of
words with licence templates. DataFrame functions only.

A block is a run of words twice as long as the template has distinct ones, at
any place of a text, over line ends. It meets a template if at least ``need =
ceil(threshold * size)`` of the template's ``size`` distinct words stand in it,
and among them the words that tell it from other licences (``TELLING``), which
count only beside another word of the template. Words of no template cannot
matter, so a text is split once, and only the places of the templates' words
are kept. Over these the join finds every pair:

* words are ordered by how many texts hold them, over the whole table, rarest
  first;
* prefix filter: a block that holds ``need`` of a template's words holds one
  of its ``size - need + 1`` rarest, so only texts are joined that hold one;
  what follows looks at the words around each place of such a word;
* length filter: there must be ``need`` distinct words of templates around it;
* positional filter: if it is the rarest of the template in a block, all others
  come behind it in the order, so ``need - 1`` words around it must.

What passes is verified at every place. The templates are a small fixed table,
whose words and their order are all that is sent to tasks."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, text_or_empty

THRESHOLD = 0.8

# Phrases of the base labels, by label.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# Wording of common licence notices, by label.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved."),
)

#: Words that tell the templates of a label from those of other licences. A
#: template is met only by blocks with all of its label's words that it has.
TELLING = {
    "gpl": ("gnu",), "lgpl": ("lesser",), "agpl": ("affero",), "apache": ("apache",), "mit": ("mit",),
    "cc-by": ("attribution",), "cc-by-nc": ("nc",), "cc-by-sa": ("sa",), "cc-by-nd": ("nd",), "mpl": ("mozilla",),
}

#: What stands between the words of the contract, whether or not A-Z are
#: lower-cased.
_GAP = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
_GAP_PLAIN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(c: Column) -> Column:
    """The words in order, A-Z lower-cased. ``lower`` also changes letters
    outside A-Z, which cannot make a word of A-Z and digits equal or unequal to
    another, but for the Kelvin sign, which it turns into k."""
    plain = F.lower(F.replace(c, F.lit("\u212a"), F.lit("\u00e9")))
    return F.array_remove(F.split(plain, _GAP), "")


@dataclass(frozen=True)
class Template:
    """``words``: the numbers of its distinct words, rarest first."""

    label: str
    words: tuple[int, ...]
    need: int
    must: tuple[int, ...]

    @property
    def span(self) -> int:
        return 2 * len(self.words)

    @property
    def prefix(self) -> tuple[int, ...]:
        return self.words[:len(self.words) - self.need + 1]


def template_words(body: str) -> list[str]:
    """The distinct words of a template, in order, as ``words`` has them."""
    return list(dict.fromkeys(w for w in re.split(_GAP_PLAIN, body.replace("\u212a", "\u00e9").lower()) if w))


def vocabulary(rows: Sequence[tuple[str, str]]) -> list[str]:
    return sorted({w for _, body in rows for w in template_words(body)})


def _ordered(rows: Sequence[tuple[str, str]], threshold: float, order: dict[str, int]) -> list[Template]:
    out = []
    for label, body in rows:
        own = template_words(body)
        need = max(1, math.ceil(threshold * len(own) - 1e-9))
        out.append(Template(label, tuple(sorted(order[w] for w in own)), need,
                            tuple(order[w] for w in TELLING.get(label, ()) if w in own)))
    return out


def _held(w: str, known: list[str]) -> Column:
    """array<struct<at, v>>: the places in ``w`` of the words ``known``, and
    their number there."""
    number = lambda x: (F.array_position(F.lit(known), x) - 1).cast("int")
    return F.filter(F.transform(w, lambda x, i: F.when(x.isin(known), F.struct(i.alias("at"), number(x).alias("v")))),
                    lambda x: x.isNotNull())


def candidates(held: DataFrame, found: list[Template], filters: Sequence[str] = ("length", "positional")) -> DataFrame:
    """(_row, _held, template, _near) of every place of a prefix word that
    passes the ``filters``; ``_near``: the template's words around it."""
    spark = held.sparkSession
    t = spark.createDataFrame([(i, x.need, x.span, list(x.words), list(x.must)) for i, x in enumerate(found)],
                              "template int, need int, span int, _words array<int>, _must array<int>")
    prefix = spark.createDataFrame([(i, v) for i, x in enumerate(found) for v in x.prefix], "template int, v int")
    hit = held.select("_row", "_held", F.explode("_held").alias("_hit")).select("_row", "_held", "_hit.at", "_hit.v")
    hit = hit.join(F.broadcast(prefix), "v").join(F.broadcast(t), "template")   # as many rows as the templates have words
    around = F.filter("_held", lambda x: F.abs(x.at - F.col("at")) < F.col("span"))
    hit = hit.withColumn("_around", around)
    block = F.array_distinct(F.transform("_around", lambda x: x.v))
    if "length" in filters:
        hit = hit.where(F.size(block) >= F.col("need"))
    if "positional" in filters:
        hit = hit.where(F.size(F.filter(block, lambda v: v > F.col("v"))) >= F.col("need") - 1)
    return hit.withColumn("_near", F.filter("_around", lambda x: F.array_contains("_words", x.v)))


def window_matches(held: DataFrame, found: list[Template]) -> DataFrame:
    """(_row, template, containment) of the templates that a block of the
    text ``_row`` meets; a pair comes once for each place of a prefix word
    near which it is met. ``held``: (_row, _held), see ``_held``."""
    hit = candidates(held, found)
    own = F.filter("_held", lambda x: F.array_contains("_words", x.v))
    told = F.filter("_near", lambda x: ~F.array_contains("_must", x.v) | F.exists("_own", lambda y: F.abs(y.at - x.at) == 1))
    hit = hit.withColumn("_own", own).withColumn("_near", told)
    hit = hit.where(F.size(F.array_distinct(F.transform("_near", lambda x: x.v))) >= F.col("need"))

    def shared(start):
        run = F.array_distinct(F.transform(F.filter(
            "_near", lambda x: (x.at >= start) & (x.at < start + F.col("span"))), lambda x: x.v))
        return F.when(F.size(F.array_except("_must", run)) == 0, F.size(run)).otherwise(0)

    best = F.array_max(F.transform("_near", lambda x: shared(x.at)))
    return hit.withColumn("_best", best).where(F.col("_best") >= F.col("need")).select(
        "_row", "template", (F.col("_best") / F.size("_words")).alias("containment"))


def phrase_places(w: Column, phrases: Sequence[tuple[str, str]] = PHRASES) -> Column:
    """array<struct<at, label>>: where the words of a phrase stand one after
    the other in ``w``, a column of words, counted from 0."""
    def places(label: str, p: list[str]) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - len(p)))
        at = F.filter(starts, lambda i: F.slice(w, i + 1, len(p)) == F.array(*map(F.lit, p)))
        return F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    return F.concat(*(places(label, phrase.split(" ")) for label, phrase in phrases))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 phrases: Sequence[tuple[str, str]] = PHRASES,
                 rows: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_words``, ``places`` (of the
    phrases: place and label), ``template_labels`` (of the templates met by
    any block) and ``containment`` (the largest, 0 if no template is met).

    A null or empty text has no words and no licence. Every row is looked at
    by itself, whether or not its key is null or repeated. An empty table
    gives no rows; other columns of ``docs`` are ignored."""
    kind = "array<struct<at:bigint,label:string>>"
    known = vocabulary(rows)
    # words are listed in a column of their own, once a row, before anything
    # is looked for in it; most rows hold no phrase's first word
    begins = F.array(*(F.lit(w) for w in sorted({p.split(" ")[0] for _, p in phrases})))
    d = docs.select(F.col(key).alias("_key"), words(text_or_empty(text)).alias("_words"))
    d = cut(d.select("_key", F.size("_words").cast("long").alias("n_words"),
                     F.when(F.arrays_overlap("_words", begins), phrase_places(F.col("_words"), phrases))
                     .otherwise(F.array().cast(kind)).alias("places"), _held("_words", known).alias("_held")))
    d = d.withColumn("_row", F.monotonically_increasing_id())       # of stored rows: the same at every read
    in_texts = d.select(F.explode(F.array_distinct(F.transform("_held", lambda x: x.v))).alias("v")).groupBy("v").count()
    count = {r.v: r["count"] for r in in_texts.collect()}           # at most the words of the templates
    order = {w: i for i, (_, w) in enumerate(sorted((count.get(i, 0), w) for i, w in enumerate(known)))}
    ranked = F.lit([order[w] for w in known])
    held = d.select("_row", F.transform("_held", lambda x: F.struct(x.at.alias("at"), F.get(ranked, x.v).alias("v"))).alias("_held"))
    found = _ordered(rows, threshold, order)
    label = F.get(F.lit([t.label for t in found]), F.col("template"))
    best = window_matches(held, found).groupBy("_row").agg(
        F.sort_array(F.collect_set(label)).alias("template_labels"), F.max("containment").alias("containment"))
    out = d.drop("_held").join(best, "_row", "left")
    return out.select(F.col("_key").alias(key), "n_words", "places",
                      F.coalesce("template_labels", F.array().cast("array<string>")).alias("template_labels"),
                      F.coalesce("containment", F.lit(0.0)).alias("containment"))
