"""License scan: base phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of consecutive words, wherever lines end. Windows are twice as long as a notice may be
(``STRETCH`` times the longest template) and overlap by half, so a notice never falls between two of them; a text that is
shorter is one block. Templates and blocks are sets of words in one global order, rarest first by the words' places in
all documents. A template of n words that must be contained to the share t is matched by ceil(t * n) words at least, so
one of its n - ceil(t * n) + 1 first words is in every matching block (prefix filter; texts without any of them are not cut
into blocks at all); blocks with fewer template words than needed cannot match (length filter), nor can meetings after
which too few words are left on either side (positional filter). What is left is confirmed on full sets. Only
built-in functions are used.

Defined results: null text counts as empty (no words, no labels, score 0); texts of any length are read whole; repeated
rows each keep a row; repeated blocks count once for labels; of several templates, all that match give their labels, and the
largest share is the score; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import ascii_lower, literal_rows, read

PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Short notices in common use, one or more for a label (fixed values).
TEMPLATES = [
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related rights"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl-2.1", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.85
STRETCH = 1.5
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _sequence_of(text: str) -> list[str]:
    text = "".join(c.lower() if c.isascii() else c for c in text)
    return "".join(c if c.isascii() and c.isalnum() or not c.isascii() else " " for c in text).split()


def _words_of(text: str) -> list[str]:
    return list(dict.fromkeys(_sequence_of(text)))


def stride(templates: list[tuple[str, str]]) -> int:
    """How many words a notice may be spread over."""
    return ceil(STRETCH * max((len(_sequence_of(text)) for _, text in templates), default=1))


def _need(n: int, threshold: float) -> int:
    return max(1, ceil(threshold * n - 1e-9))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>") if values else F.expr("cast(array() as array<string>)")


def _spaced(text: Column) -> Column:
    """The words of a lower-cased text, each with one space before it and one after the last."""
    flat = F.trim(F.regexp_replace(text, NOT_WORD, " "))
    return F.when(flat == "", F.lit("")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _blocks(spaced: Column, width: int, vocabulary: list[str], least: int) -> Column:
    """For each window of 2 * width words, every ``width`` words, the template words that it holds, if they are enough."""
    words = F.split(F.trim(spaced), " ")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(words) / width).cast("int") - 2, F.lit(0)))
    windows = F.transform(starts, lambda k: F.array_intersect(F.slice(words, k * width + 1, 2 * width), _strings(vocabulary)))
    return F.filter(windows, lambda held: F.size(held) >= least)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Base phrase places and license labels for every row of docs(doc_id, text).

    ``phrases`` and ``templates`` are lists of (phrase, label) and (label, text): what a person wrote down.
    """
    sets = [(label, _words_of(text)) for label, text in templates]
    sets = [(label, words) for label, words in sets if words]
    vocabulary = sorted({w for _, words in sets for w in words})
    least = min([_need(len(words), threshold) for _, words in sets], default=1 << 30)
    lower = docs.select("doc_id", ascii_lower(F.coalesce(F.col("text"), F.lit(""))).alias("text"))

    # Global order: rarest word first, by its places in all texts.
    lower = lower.withColumn("spaced", _spaced(F.col("text")))
    places_of = lower.select(F.explode(F.split(F.trim("spaced"), " ")).alias("word")).where(F.col("word").isin(vocabulary)).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in places_of.collect()} if vocabulary else {}  # one row for each template word at most
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    ordered = [(label, sorted(words, key=order.__getitem__), _need(len(words), threshold)) for label, words in sets]
    prefixes = [
        (word, place, label, words, need) for label, words, need in ordered for place, word in enumerate(words[: len(words) - need + 1])
    ]
    spark = docs.sparkSession
    table = literal_rows(spark, prefixes, ["word", "template_place", "template_label", "template", "need"], ["string", "int", "string", "array<string>", "int"])

    ranked = F.array_sort(F.transform(F.col("block"), lambda w: F.struct(F.element_at(_order_map(order), w).alias("k"), w.alias("w"))))
    first_words = sorted({p[0] for p in prefixes}, key=order.__getitem__, reverse=True)
    may_match = reduce(lambda a, b: a | b, (F.contains(F.col("spaced"), F.lit(f" {w} ")) for w in first_words), F.lit(False))
    spaced = lower.select(
        "doc_id",
        "spaced",
        F.when(may_match, _blocks(F.col("spaced"), stride(templates), vocabulary, least)).alias("blocks"),
    ).withColumn("row", F.monotonically_increasing_id())
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        padded = f" {phrase} "
        has = F.contains(F.col("spaced"), F.lit(padded))
        before = F.col("spaced").substr(F.lit(1), F.locate(padded, F.col("spaced")))
        tail = F.substring_index("spaced", padded, -1)
        upto = F.length("spaced") - F.length(tail) - len(padded) + 1
        places.append(F.when(has, F.regexp_count("spaced", F.lit(f" {phrase}(?= )"))).otherwise(F.lit(0)))
        firsts.append(F.when(has, _spaces(before) - 1))
        lasts.append(F.when(has, _spaces(F.col("spaced").substr(F.lit(1), upto)) - 1))
        labels.append(F.when(has, F.lit(label)))
    none = F.lit(None).cast("int")
    base = spaced.select(
        "row",
        "doc_id",
        F.greatest(_spaces(F.col("spaced")) - 1, F.lit(0)).cast("long").alias("n_words"),
        reduce(lambda a, b: a + b, places, F.lit(0)).cast("long").alias("n_base"),
        F.least(*firsts, none, none).cast("long").alias("first_word"),
        F.greatest(*lasts, none, none).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"),
        "blocks",
    )
    words = base.withColumn("block", F.explode_outer("blocks")).drop("blocks").withColumn("block", F.transform(ranked, lambda x: x["w"]))
    words = words.select("*", F.posexplode_outer("block").alias("place", "word"))
    met = words.join(F.broadcast(table), "word", "left")
    left = 1 + F.least(F.size("template") - F.col("template_place") - 1, F.size("block") - F.col("place") - 1)
    shared = F.size(F.array_intersect("block", "template"))
    possible = (F.size("block") >= F.col("need")) & (left >= F.col("need"))
    found = F.when(possible, F.when(shared >= F.col("need"), F.struct(F.col("template_label").alias("label"), (shared / F.size("template")).alias("share"))))
    per = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    grouped = met.withColumn("found", found).groupBy(*per).agg(F.collect_set("found.label").alias("own"), F.max("found.share").alias("share"))
    return grouped.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _order_map(order: dict[str, int]) -> Column:
    if not order:
        return F.expr("cast(map() as map<string,int>)")
    return F.map_from_arrays(_strings(list(order)), F.array(*map(F.lit, order.values())))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


QUERIES = {"op8_license_scan": op8_license_scan}


def _oracle() -> str:
    sets = ", ".join(f"('{label}', {words!r}, {_need(len(words), THRESHOLD)})" for label, words in ((a, _words_of(b)) for a, b in TEMPLATES))
    phrases = ", ".join(f"('{label}', {p.split()!r})" for p, label in PHRASES)
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    width = stride(TEMPLATES)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH templates(label, words, need) AS (VALUES {sets}), phrases(label, words) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS rn, doc_id, {low} AS t FROM documents),
w AS (SELECT rn, doc_id, regexp_extract_all(t, '{word}') AS words FROM d),
starts AS (SELECT rn, words, unnest(range(len(words))) AS i FROM w),
places AS (SELECT rn, i, p.label FROM starts s JOIN phrases p ON s.words[i + 1] = p.words[1] AND s.words[i + 1 : i + len(p.words)] = p.words),
base AS (SELECT rn, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY rn),
blocks AS (SELECT rn, words, unnest(range(greatest(1, ceil(len(words) / {width})::INT - 1))) AS k FROM w),
windows AS (SELECT rn, list_distinct(words[k * {width} + 1 : k * {width} + 2 * {width}]) AS words FROM blocks),
own AS (SELECT rn, list(DISTINCT label) AS labels, max(len(list_intersect(l.words, t.words)) / len(t.words)) AS share
  FROM windows l JOIN templates t ON len(list_intersect(l.words, t.words)) >= t.need GROUP BY rn)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(own.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (rn) LEFT JOIN own USING (rn)"""


ORACLE = {"op8_license_scan": _oracle()}
