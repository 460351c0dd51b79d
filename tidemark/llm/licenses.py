"""License scans: text blocks that contain the wording of a license notice, and fixed phrases.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower case. A
block is a paragraph, that is, what lies between lines without a word. The tokens of a block or a
template are its pairs of adjacent words, so their order counts. A block matches a template if it
contains at least ``threshold`` of the template's tokens; a label of the template is then a label of
the document. Beside that, places where the words of a phrase stand one after the other are counted.

The search is an exact join on set similarity. Tokens are ordered by the number of blocks they are
in, rare ones first. To share ``need = ceil(threshold * size)`` tokens, a block must hold one of the
first ``size - need + 1`` tokens of the template, and among its own all but the last ``need - 1``
(prefix filter); it must have ``need`` tokens (length filter); and behind the first token in common
enough must follow on both sides (position filter). What is left is counted in full. Tokens that no
template has cannot be shared, so blocks are kept without them; the result is the same.

Everything is a column expression. Texts are read once: each row's own figures and its blocks,
reduced to the tokens of templates, are written; frequencies, prefixes and counts come from that.
What is broadcast are the templates' tokens, a parameter that does not grow with the data. There is
one shuffle of blocks with tokens of templates, keyed by row and block, and one of results per row.

Defined cases: null and empty texts have no words, no places and empty labels, and a score of 0.
Each row has a result of its own, whatever its id. A text of any length is searched whole. A
template without a pair of words matches nothing. An empty table gives no rows. Only the id and text
columns are read, whatever other columns are called."""

from __future__ import annotations

import re
from collections.abc import Iterable
from fractions import Fraction
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.cluster import written

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
THRESHOLD = 0.8

# Phrases and their labels (fixed values).
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Wording of public license notices, a paragraph each, and their labels (fixed values).
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the"
     " License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either"
     " express or implied. See the License for the specific language governing permissions and"
     " limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
     " provided that the following conditions are met:"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
     " License."),
    ("cc0", "To the extent possible under law, the author(s) have dedicated all copyright and related and"
     " neighboring rights to this software to the public domain worldwide."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the"
     " GNU General Public License as published by the Free Software Foundation, either version 3 of the"
     " License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
     " fee is hereby granted, provided that the above copyright notice and this permission notice appear"
     " in all copies."),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public"
     " License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
     " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
     " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
     " sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is"
     " furnished to do so, subject to the following conditions:"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy"
     " of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case. Other letters may change case too, but none becomes ASCII:
    the one that would, the Kelvin sign, takes the slower way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.contains("K"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{BREAK}+"), "")


def pairs(found: Column) -> Column:
    """Adjacent words, joined by a space; the last word stands alone and equals no pair."""
    following = F.slice(found, 2, F.greatest(F.size(found), F.lit(1)))
    return F.zip_with(found, following, lambda a, b: F.concat_ws(" ", a, b))


def tokens(text: str) -> set[str]:
    """The pairs of words of a template."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = [w for w in re.split(f"{BREAK}+", lower) if w]
    return {f"{a} {b}" for a, b in zip(found, found[1:])}  # noqa: B905


def places(found: Column, phrase: str) -> Column:
    """Numbers of the words where ``phrase`` begins."""
    parts = phrase.split(" ")
    at = lambda i: reduce(and_, (F.get(found, i + k) == w for k, w in enumerate(parts)))
    there = reduce(and_, (F.array_contains(found, w) for w in parts))
    every = F.when(there, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(every, at)


def marked(docs: DataFrame, known: list[str], least: int, phrases: Iterable[tuple[str, str]],
           id_col: str, text_col: str) -> DataFrame:
    """Per row its figures and ``blocks``: the known tokens of each block that has ``least`` or more."""
    phrases, nothing = list(phrases), F.array().cast("array<array<string>>")
    rows = docs.select(docs[id_col].alias("id"), lowered(F.coalesce(docs[text_col], F.lit(""))).alias("text"))
    rows = rows.select("id", "text", words(F.col("text")).alias("words"))
    vocabulary = F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")
    # Few texts have enough tokens of templates at all; only those are cut into paragraphs.
    some = F.size(F.array_intersect(pairs(F.col("words")), vocabulary)) >= least
    cut = F.split(F.col("text"), rf"\n{BREAK}*\n")
    kept = F.transform(cut, lambda b: F.array_intersect(pairs(words(b)), vocabulary))
    rows = rows.select(
        "id", F.size("words").cast("bigint").alias("n_words"),
        *(places(F.col("words"), p).alias(f"at{i}") for i, (p, _) in enumerate(phrases)),
        F.when(some, kept).otherwise(nothing).alias("kept"),
    )
    at = [F.col(f"at{i}") for i in range(len(phrases))]
    every = F.concat(*at) if at else F.array().cast("array<int>")
    labels = [F.when(F.size(a) > 0, F.lit(label)) for a, (_, label) in zip(at, phrases, strict=True)]
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "n_words",
        F.size(every).cast("bigint").alias("n_base"),
        F.array_min(every).cast("bigint").alias("first_word"),
        F.array_max(every).cast("bigint").alias("last_word"),
        F.array_compact(F.array(*labels)).cast("array<string>").alias("base"),
        F.filter("kept", lambda b: F.size(b) >= least).alias("blocks"),
    )


def needed(size: int, threshold: float) -> int:
    """Tokens of ``size`` that a block must hold."""
    return ceil(Fraction(str(threshold)) * size)


def table(spark: SparkSession, rows: Iterable[tuple], names: Iterable[str]) -> DataFrame:
    """A small table of constants."""
    held = F.array(*(F.struct(*(_constant(v).alias(c) for c, v in zip(names, r, strict=True))) for r in rows))
    return spark.range(1).select(F.explode(held).alias("r")).select("r.*")


def _constant(value) -> Column:
    return F.array(*map(F.lit, value)).cast("array<string>") if isinstance(value, list) else F.lit(value)


def template_tokens(spark: SparkSession, templates: list[set[str]], threshold: float) -> DataFrame:
    rows = [(i, sorted(own), len(own), needed(len(own), threshold)) for i, own in enumerate(templates)]
    names = ["template", "tokens", "size", "need"]
    return table(spark, rows, names).select("template", F.explode("tokens").alias("token"), "size", "need")


def ranked(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """``token`` and ``rank`` of the templates' tokens, those in the fewest blocks first."""
    counted = blocks.select(F.explode("held").alias("token")).groupBy("token").agg(F.count("*").alias("blocks"))
    counted = wanted.select("token").distinct().join(counted, "token", "left")
    # One window over all, but only of the templates' tokens, whatever the size of the data.
    order = Window.orderBy(F.coalesce("blocks", F.lit(0)), "token")
    return counted.select("token", F.row_number().over(order).alias("rank"))


def matches(rows: DataFrame, templates: list[set[str]], threshold: float = THRESHOLD) -> DataFrame:
    """``row``, ``block``, ``template`` (its number) and ``containment`` of every block and template
    that match; ``rows`` has ``row`` and the ``blocks`` of ``marked``."""
    wanted = template_tokens(rows.sparkSession, templates, threshold)
    least = min((needed(len(own), threshold) for own in templates if own), default=1)
    blocks = rows.select("row", F.posexplode("blocks").alias("block", "held"))
    ranks = ranked(blocks, wanted)
    sets = F.sort_array(F.collect_list("rank"))
    held = (
        blocks.select("row", "block", F.explode("held").alias("token")).join(F.broadcast(ranks), "token")
        .groupBy("row", "block").agg(sets.alias("held"))
    )
    prefixes = (
        wanted.join(F.broadcast(ranks), "token").groupBy("template", "size", "need").agg(sets.alias("wanted"))
        .select("*", F.posexplode(F.expr("slice(wanted, 1, size - need + 1)")).alias("i", "rank"))
    )
    found = held.select(
        "*", F.posexplode(F.slice("held", 1, F.greatest(F.size("held") - (least - 1), F.lit(0)))).alias("j", "rank")
    ).join(F.broadcast(prefixes), "rank")
    # A block that matches passes at the first token it shares; what it does at others is no matter.
    behind = F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j"))
    shared = F.size(F.array_intersect("held", "wanted"))
    return (
        found.where((F.size("held") >= F.col("need")) & (behind >= F.col("need")))
        .select("row", "block", "template", "size", "need", shared.alias("shared"))
        .where("shared >= need").select("row", "block", "template", (F.col("shared") / F.col("size")).alias("containment"))
        .distinct()
    )


def scan(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, phrases: Iterable[tuple[str, str]] = PHRASES,
         threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base (places of phrases), first_word and last_word (the smallest and
    largest of their beginnings), base_labels, labels (also of templates; both sorted and joined by
    commas), and ``score``: 1 with a phrase, else the largest containment of a match, else 0."""
    spark, templates = docs.sparkSession, list(templates)
    own = [tokens(text) for _, text in templates]
    known = sorted(set().union(*own))
    least = min((needed(len(t), threshold) for t in own if t), default=1)
    rows = written(marked(docs, known, least, phrases, id_col, text_col), "license-blocks")
    if not known:
        best = spark.createDataFrame([], "row bigint, more array<string>, containment double")
        return _results(rows, best, id_col)
    labels = table(spark, [(i, label) for i, (label, _) in enumerate(templates)], ["template", "label"])
    best = (
        matches(rows, own, threshold).join(F.broadcast(labels), "template")
        .groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    )
    return _results(rows, best, id_col)


def _results(rows: DataFrame, best: DataFrame, id_col: str) -> DataFrame:
    joined = rows.drop("blocks").join(best, "row", "left")
    text = lambda found: F.array_join(F.array_sort(F.array_distinct(found)), ",")
    every = F.concat("base", F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        text(F.col("base")).alias("base_labels"), text(every).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
