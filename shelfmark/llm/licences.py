"""Licence notices, in DataFrame functions only: base phrases, and an exact set-similarity join with templates.

A block of text (a line, or a paragraph for templates of many words) takes a template's label if it holds enough of the
template's different words.  Words are ordered by their frequency over all blocks, rarest first.  A block and a template
that share enough words share one among the first few of either (prefix filter); the block must have that many words at
all (length filter), and so must what is left after the shared one (positional filter).  What passes is counted.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Labels and sentences of common licence notices (fixed values).
TEMPLATES = (
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("artistic", "licensed under the Artistic License 2.0"),
    ("bsd", "Released under the BSD License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0"),
    ("eclipse", "made available under the terms of the Eclipse Public License 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Share of a template's different words that a block must hold, in percent.
PERCENT = 90
#: Templates with so many different words or more are looked for in paragraphs, as their lines may be wrapped.
WIDE = 12


def template_words(text: str) -> list[str]:
    """The different words of a template, as documents are cut into words."""
    small = "".join(_LOWER[_UPPER.index(c)] if c in _UPPER else c for c in text)
    return list(dict.fromkeys(w for w in re.split(NOT_WORD, small) if w))


def needed(words: int, percent: int = PERCENT) -> int:
    return max(1, -(-words * percent // 100))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _base_places(padded: Column, n_words: Column, phrases: Mapping[str, str]) -> tuple[Column, Column, Column, Column]:
    """Number of places, first and last place, and labels of all phrases, in words between single spaces."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        here = F.contains(padded, F.lit(f" {phrase} "))
        pieces = F.split(padded, f" {phrase}(?= )", -1)
        counts.append(F.when(here, F.size(pieces) - 1).otherwise(0))
        firsts.append(F.when(here, _spaces(F.element_at(pieces, 1))))
        lasts.append(F.when(here, n_words - (_spaces(F.element_at(pieces, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(here, F.lit(label)))
    nothing = F.lit(None).cast("int")  # so that there are always two to choose from
    total = sum(counts, F.lit(0))
    return total, F.least(nothing, nothing, *firsts), F.greatest(nothing, nothing, *lasts), F.array_compact(F.array(*labels))


def similar_blocks(blocks: DataFrame, templates: Sequence[tuple[str, str]], percent: int = PERCENT) -> DataFrame:
    """``(row, label, containment)`` of all blocks that hold ``percent`` of a template's words.

    ``blocks`` has ``row``, ``no``, ``wide`` (whether the block is a paragraph) and ``tokens``, the different words of the
    block that any template has.  The templates, their words and the counts of those words are on the driver: what
    is there doesn't grow with the blocks.
    """
    spark = blocks.sparkSession
    sets = [(label, template_words(text)) for label, text in templates]
    kinds = [(label, words, needed(len(words), percent), len(words) >= WIDE) for label, words in sets if words]
    counted = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count()
    held = {r["token"]: r["count"] for r in counted.collect()}  # one row per word of the templates
    ordered = sorted({w for _, words, _, _ in kinds for w in words}, key=lambda w: (held.get(w, 0), w))
    place = {w: k for k, w in enumerate(ordered)}
    index, whole = [], []
    for number, (label, words, need, wide) in enumerate(kinds):
        words = sorted(words, key=place.__getitem__)
        whole.append((number, label, words))
        index += [(w, wide, number, i, len(words), need) for i, w in enumerate(words[: len(words) - need + 1])]
    if not kinds:
        return spark.createDataFrame([], "row long, label string, containment double")
    prefixes = spark.createDataFrame(index, "token string, wide boolean, template int, i int, size int, need int")
    wholes = spark.createDataFrame(whole, "template int, label string, words array<string>")
    # The intersection keeps the order of its first array: a block's words, rarest first.
    in_order = F.array_intersect(F.array(*[F.lit(w) for w in ordered]), F.col("tokens"))
    least = {wide: min((need for _, _, need, w in kinds if w == wide), default=1) for wide in (False, True)}
    sorted_blocks = blocks.select("row", "no", "wide", in_order.alias("tokens")).withColumn("n", F.size("tokens"))
    prefix = F.slice("tokens", F.lit(1), F.greatest(F.col("n") - F.when(F.col("wide"), least[True]).otherwise(least[False]) + 1, F.lit(0)))
    probes = sorted_blocks.select("row", "no", "wide", "tokens", "n", F.posexplode(prefix).alias("j", "token"))
    # Both sides are bounded by the templates, which are a parameter.
    met = probes.join(F.broadcast(prefixes), ["token", "wide"]).where(
        (F.col("n") >= F.col("need")) & (1 + F.least(F.col("size") - 1 - F.col("i"), F.col("n") - 1 - F.col("j")) >= F.col("need"))
    )
    # A pair meets at every word that both prefixes share; counting it again is cheaper than a shuffle.
    exact = met.join(F.broadcast(wholes), "template").withColumn("both", F.size(F.array_intersect("tokens", "words")))
    return exact.where("both >= need").select("row", "label", (F.col("both") / F.col("size")).alias("containment"))


def scan_licences(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    percent: int = PERCENT,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(<ident>, n_words, n_base, first_word, last_word, base_labels, labels, score)``, a row per row of ``docs``.

    The score is the largest share of a template that a block holds, where it is enough for the label, 1 where a base
    phrase stands, else 0.  Null and empty texts have no words, labels or places and score 0; rows that repeat an ident are
    scanned each by itself, null idents too.
    """
    sets = [template_words(t) for _, t in templates]
    vocabulary = {wide: sorted({w for words in sets if (len(words) >= WIDE) == wide for w in words}) for wide in (False, True)}
    least = {wide: min((needed(len(s), percent) for s in sets if s and (len(s) >= WIDE) == wide), default=1) for wide in (False, True)}
    small = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    cleaned = F.transform(F.split(small, "\n", -1), lambda line: F.trim(F.regexp_replace(line, NOT_WORD, " ")))
    rows = docs.select(F.col(ident), cleaned.alias("_lines"))
    words = F.array_join(F.filter("_lines", lambda line: line != ""), " ")
    rows = rows.select(ident, "_lines", F.concat(F.lit(" "), words, F.lit(" ")).alias("_padded"), (words != "").alias("_some"))
    n_words = F.when(F.col("_some"), _spaces(F.col("_padded")) - 1).otherwise(0)

    def blocks(texts: Column, wide: bool) -> Column:
        if not vocabulary[wide]:
            return F.array().cast("array<struct<wide:boolean,tokens:array<string>>>")
        own = F.transform(
            texts,
            lambda t: F.struct(F.lit(wide).alias("wide"), F.array_distinct(F.filter(F.split(t, "[ \n]"), lambda w: w.isin(vocabulary[wide]))).alias("tokens")),
        )
        return F.filter(own, lambda b: F.size(b.tokens) >= least[wide])

    paragraphs = F.split(F.array_join("_lines", "\n"), "\n{2,}")
    count, first, last, labels = _base_places(F.col("_padded"), n_words, phrases)
    scanned = rows.select(
        ident,
        F.monotonically_increasing_id().alias("_row"),  # written next, so that it stays
        n_words.cast("long").alias("n_words"),
        count.cast("long").alias("n_base"),
        first.cast("long").alias("first_word"),
        last.cast("long").alias("last_word"),
        labels.alias("_base"),
        F.concat(blocks(F.col("_lines"), False), blocks(paragraphs, True)).alias("_blocks"),
    )
    scanned = materialise(scanned, "licence-scan")
    exploded = scanned.select(F.col("_row").alias("row"), F.posexplode("_blocks").alias("no", "b")).select("row", "no", "b.wide", "b.tokens")
    found = similar_blocks(exploded, templates, percent).groupBy("row").agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_share"))
    joined = scanned.join(found.withColumnRenamed("row", "_row"), "_row", "left")
    base, more = F.array_sort(F.array_distinct("_base")), F.coalesce("_more", F.array().cast("array<string>"))
    return joined.select(
        ident,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.coalesce("_share", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
