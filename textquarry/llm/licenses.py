"""License scans: an exact set-similarity join of text blocks with license templates.

Each template is the set of its words, and a block of text matches if it holds at least a
share ``least`` of them. Blocks are windows of twice a width, a width apart, so that any
passage of up to a width lies in one of them; a template's width is the next power of two
over its length. Words are ordered by how many documents hold them, rarest first, and the
join keeps to that order: a template and a block that share ``alpha`` words must share one
within the first ``size - alpha + 1`` of each (prefix filter), a block needs ``alpha``
template words at all (length filter), and what stands behind the last shared word must
still suffice (positional filter). Pairs that pass are counted exactly, so the filters
decide the cost, never the result. Words outside all templates cannot be shared and are left out
of the blocks.

Everything is a built-in function. The templates are a parameter of bounded size: their words
are literals of the plan, and only their counts reach the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.hashing import let
from textquarry.llm.common import materialize, text_of
from textquarry.operators.skew import lookup_by_frequency

# The texts by which licenses are granted, and the phrases that name one.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))

LEAST = 0.9
LEAST_WIDTH = 8
# The bound on what the plan holds as literals.
MAX_TEMPLATE_WORDS = 20_000

_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
_BETWEEN = "".join(chr(c) for c in range(128) if not (chr(c).isdigit() or chr(c).isalpha()))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)}))


def text_words(text: Column) -> Column:
    """Runs of anything but ASCII signs, white space and controls, with A-Z in lower case."""
    spaced = F.translate(text, _UPPER + _BETWEEN, _UPPER.lower() + " " * len(_BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def width_of(words: Sequence[str]) -> int:
    return max(LEAST_WIDTH, 1 << (len(words) - 1).bit_length())


def _literal(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _table(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[(_literal(v) if isinstance(v, list) else F.lit(v)).alias(n) for n, v in zip(names, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def word_order(docs: DataFrame, words: list[str], text_col: str = "text") -> list[str]:
    """``words`` by the number of rows that hold each, rarest first."""
    held = F.explode(F.array_intersect(_literal(words), text_words(text_of(text_col)))).alias("word")
    counts = {r["word"]: r["n"] for r in docs.select(held).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(words, key=lambda w: (counts.get(w, 0), w))


def _identity(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(42), text).alias("h2")]


def match_templates(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
    text_col: str = "text",
) -> DataFrame:
    """``h1, h2, label, template, first_word, end_word, containment``: every match of a block.

    ``h1, h2`` identify the text (see ``scan_licenses``), ``template`` is the number of the
    template, and the block is the words from ``first_word`` to before ``end_word``. Equal texts
    give equal matches once. NULL and empty texts have none.
    """
    spark = docs.sparkSession
    sets = [list(dict.fromkeys(plain_words(text))) for _, text in templates]
    if any(not s for s in sets) or sum(map(len, sets)) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates need a word each and {MAX_TEMPLATE_WORDS} at most in all")
    rank = {w: i for i, w in enumerate(word_order(docs, sorted({w for s in sets for w in s}), text_col))}
    sets = [sorted(s, key=rank.__getitem__) for s in sets]
    alphas = [math.ceil(least * len(s) - 1e-9) or 1 for s in sets]
    widths = [width_of(plain_words(text)) for _, text in templates]
    prefixes = [s[: len(s) - a + 1] for s, a in zip(sets, alphas)]

    text = text_of(text_col)
    texts = docs.select(*_identity(text), text_words(text).alias("words"))
    rare = sorted({w for p in prefixes for w in p})
    texts = texts.where(F.arrays_overlap("words", _literal(rare)))
    blocks = None
    for width in sorted(set(widths)):
        own = [k for k, w in enumerate(widths) if w == width]
        ordered = sorted({w for k in own for w in sets[k]}, key=rank.__getitem__)
        shortest = min(alphas[k] for k in own)
        last = F.greatest(F.ceil(F.size("words") / width) - 2, F.lit(0)).cast("int")
        placed = texts.select("h1", "h2", "words", F.explode(F.sequence(F.lit(0), last)).alias("block"))
        held = F.array_intersect(_literal(ordered), F.slice("words", F.col("block") * width + 1, F.lit(2 * width)))
        kept = placed.select(
            "h1", "h2", F.lit(width).alias("width"), (F.col("block") * width).cast("bigint").alias("first_word"),
            (F.least(F.size("words"), (F.col("block") + 2) * width)).cast("bigint").alias("end_word"),
            held.alias("held"), F.lit(shortest).alias("shortest"),
        ).where(F.size("held") >= shortest)
        blocks = kept if blocks is None else blocks.union(kept)

    # At most MAX_TEMPLATE_WORDS rows each.
    index = _table(
        spark,
        [(widths[k], w, k, i) for k, p in enumerate(prefixes) for i, w in enumerate(p)],
        ["_width", "_word", "template", "i"],
    )
    facts = _table(
        spark,
        [(k, templates[k][0], s, len(s), alphas[k]) for k, s in enumerate(sets)],
        ["_template", "label", "words", "n", "alpha"],
    )
    prefix = F.slice("held", F.lit(1), F.size("held") - F.col("shortest") + 1)
    seeds = blocks.select("*", F.posexplode(prefix).alias("j", "word"))
    met = seeds.join(F.broadcast(index), (F.col("width") == F.col("_width")) & (F.col("word") == F.col("_word")))
    met = met.join(F.broadcast(facts), F.col("template") == F.col("_template"))
    behind = F.least(F.col("n") - F.col("i") - 1, F.size("held") - F.col("j") - 1)
    met = met.where(behind + 1 >= F.col("alpha"))
    pairs = met.groupBy("h1", "h2", "first_word", "end_word", "template", "label", "n", "alpha", "held", "words").agg(
        F.count_distinct("j").alias("shared"), F.max("i").alias("i"), F.max("j").alias("j")
    )
    overlap = F.size(F.array_intersect("words", "held"))
    return (
        pairs.where(F.col("shared") + behind >= F.col("alpha"))
        .withColumn("overlap", overlap)
        .where("overlap >= alpha")
        .select("h1", "h2", "label", "template", "first_word", "end_word", (F.col("overlap") / F.col("n")).alias("containment"))
    )


def _phrase_places(words: Column, label: str, parts: list[str]) -> Column:
    """``word, label`` of every place where ``parts`` stand one after the other."""

    def starts(held: Column) -> Column:
        def here(i: Column) -> Column:
            fits = [F.coalesce(F.get(held, i + k) == part, F.lit(False)) for k, part in enumerate(parts)]
            return reduce(and_, fits)

        at = F.filter(F.sequence(F.lit(0), F.size(held) - 1), here)
        return F.transform(at, lambda i: F.struct(i.cast("bigint").alias("word"), F.lit(label).alias("label")))

    none = F.array().cast("array<struct<word:bigint,label:string>>")
    return F.when(F.array_contains(words, max(parts, key=len)), let(words, starts)).otherwise(none)


def _places(words: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    return F.concat(*[_phrase_places(words, label, plain_words(phrase)) for label, phrase in phrases])


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    least: float = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, n_words, places, base_labels, matches, labels, score`` for every row of ``docs``.

    ``places`` are the ``word, label`` where a phrase stands, ``matches`` the blocks that hold
    a template (``label, template, first_word, end_word, containment``); ``labels`` are those of
    both, sorted. ``score`` is 1 with a phrase, else the best containment of a match, else 0.
    A NULL text is empty; empty texts have no words and no labels. Repeated rows and NULL ids are
    rows of their own; other columns are left aside; an empty table gives no rows.
    """
    matches = match_templates(docs, templates, least, text_col)
    packed = F.struct("first_word", "end_word", "template", "label", "containment")
    key = F.concat_ws("|", "h1", "h2")
    found = materialize(
        matches.groupBy("h1", "h2")
        .agg(F.array_sort(F.collect_list(packed)).alias("matches"))
        .withColumn("_key", key)
        .drop("h1", "h2"),
        "license-matches",
    )
    # How often each text occurs, so that one that is very common is dealt over many tasks.
    text = text_of(text_col)
    keyed = docs.select(F.col(id_col), text.alias("_text"), *_identity(text)).withColumn("_key", key).drop("h1", "h2")
    often = keyed.select("_key").join(found.select("_key"), "_key", "left_semi").groupBy("_key").agg(F.count("*").alias("_often"))
    found = found.join(often, "_key")
    words = keyed.select(id_col, "_key", text_words(F.col("_text")).alias("_words"))
    based = words.select(
        id_col, "_key", F.size("_words").cast("bigint").alias("n_words"), _places(F.col("_words"), phrases).alias("places")
    )
    scored = lookup_by_frequency(based, found, "_key", "_often", [id_col, "_key"])
    none = F.array().cast(found.schema["matches"].dataType)
    scored = scored.withColumn("matches", F.coalesce("matches", none)).withColumn(
        "base_labels", F.array_sort(F.array_distinct(F.col("places.label")))
    )
    best = F.coalesce(F.array_max(F.col("matches.containment")), F.lit(0.0))
    return scored.select(
        id_col,
        "n_words",
        "places",
        "base_labels",
        "matches",
        F.array_sort(F.array_union("base_labels", F.col("matches.label"))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
