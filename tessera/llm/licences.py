"""Licence scans with a positional index of rare words, in DataFrame functions only.

Each template is a run of words; part of it, the key phrase, must stand word for
word. A file's licence words are ranked by inverse document frequency over the whole
corpus, and a template is looked up if the file has all words of its key. The places
of its rarest ones in the file, less their places in the template, are where the
template would begin; beginnings on which these postings all agree are verified by
the whole key phrase and scored by the share of the template's words in their places.
Posted words are words of the key, so no place of a phrase is missed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared

#: Labels, the words of their phrases, and which of them must stand (a span of word places).
TEMPLATES = [
    ("mit", "under the mit license", (0, 4), True),
    ("apache-2", "apache license version 2", (0, 4), True),
    ("cc-by-nc", "cc by nc", (0, 3), True),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", (0, 6), False),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", (3, 6), False),
    ("gpl-3", "gnu general public license version 3", (0, 6), False),
    ("gpl-2", "gnu general public license version 2", (0, 6), False),
    ("lgpl", "gnu lesser general public license", (0, 5), False),
    ("agpl-3", "gnu affero general public license", (0, 5), False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", (0, 5), False),
    ("mpl-2", "mozilla public license", (0, 3), False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", (0, 8), False),
    ("unlicense", "this is free and unencumbered software released into the public domain", (2, 6), False),
    ("cc-by-sa", "cc by sa", (0, 3), False),
    ("cc-by-nc", "creative commons attribution noncommercial", (0, 4), False),
    ("cc-by-sa", "creative commons attribution sharealike", (0, 4), False),
    ("all-rights-reserved", "all rights reserved", (0, 3), False),
]
#: Rare words of a template whose places must agree, and the share of its words that a match needs.
POSTED = 3
COVERAGE = 0.5
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN = "K"  # lower() would make an ASCII letter of it


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]
    base: bool


def templates() -> list[Template]:
    return [Template(label, tuple(text.split()), key, base) for label, text, key, base in TEMPLATES]


def words_of(text: Column) -> Column:
    """The words of a text in lower case."""
    return F.array_remove(F.split(F.lower(F.replace(text, F.lit(_KELVIN), F.lit("�"))), _BETWEEN), "")


def inverse_document_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Of the licences' words, over all documents (column words)."""
    found = F.array_intersect("words", F.array(*map(F.lit, vocabulary)))
    rows = words.agg(F.count("*").alias("n")).collect()[0].n, words.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    held = {r.word: r.n for r in rows[1]}
    return {w: math.log((rows[0] + 1) / (held.get(w, 0) + 1)) for w in vocabulary}


def postings(template: Template, idf: dict[str, float], posted: int = POSTED) -> list[tuple[str, int]]:
    """(word, place) of the rarest words of the template's key phrase, the rarest first, each word once."""
    out: dict[str, int] = {}
    for i in sorted(range(*template.key), key=lambda i: (-idf[template.words[i]], i)):
        out.setdefault(template.words[i], i)
    return list(out.items())[:posted]


def scan(docs: DataFrame, posted: int = POSTED, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and matches of every row.

    matches holds template, label, start and share of every verified place. A null
    or empty text has no words, no labels and score 0. Rows are scanned one by one:
    repeated rows alike, an empty table as empty; other columns are left aside.
    """
    found = templates()
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    idf = inverse_document_frequencies(words, sorted({w for t in found for w in t.words}))
    index = [postings(t, idf, posted) for t in found]
    rare, keys = sorted({w for own in index for w, _ in own}), sorted({w for t in found for w in t.words[slice(*t.key)]})

    # places of the words that some template posts, and which words of keys the file has; both by one pass over its words
    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(rare), F.struct(w.alias("word"), i.alias("at")))), lambda x: x.isNotNull())
    held = words.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    held = held.withColumn("has", F.when(F.size("hits") > 0, F.array_intersect("words", F.array(*map(F.lit, keys)))).otherwise(F.array().cast("array<string>")))
    none = F.array().cast("array<struct<template:int,label:string,base:boolean,start:int,share:double>>")
    strings = lambda x: F.array(*map(F.lit, x))

    def kind_of(number: int, t: Template, own: list[tuple[str, int]]) -> Column:
        key = t.words[slice(*t.key)]
        posted = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(p).alias("place")) for w, p in own])
        return F.struct(F.lit(number).alias("template"), F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), strings(t.words).alias("words"), F.lit(t.key[0]).alias("at"), strings(key).alias("key"), posted.alias("posted"))

    kinds = F.array(*[kind_of(i, t, own) for i, (t, own) in enumerate(zip(found, index, strict=True))])

    def begins(p: Column) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == p["word"]), lambda h: h["at"] - p["place"])

    def scored(kind: Column, start: Column) -> Column:
        own = F.transform(kind["words"], lambda w, i: F.when((start + i >= 0) & (F.get("words", start + i) == w), 1).otherwise(0))
        share = F.aggregate(own, F.lit(0), lambda a, b: a + b) / F.size(kind["words"])
        return F.struct(kind["template"].alias("template"), kind["label"].alias("label"), kind["base"].alias("base"), start.alias("start"), share.cast("double").alias("share"))

    def matched(kind: Column) -> Column:
        agreed = F.aggregate(F.slice(kind["posted"], 2, posted), begins(F.element_at(kind["posted"], 1)), lambda so_far, p: F.array_intersect(so_far, begins(p)))
        stands = F.filter(agreed, lambda x: (x + kind["at"] >= 0) & (F.slice("words", F.greatest(x + kind["at"], F.lit(0)) + 1, F.size(kind["key"])) == kind["key"]))
        return F.filter(F.transform(stands, lambda x: scored(kind, x)), lambda m: m["share"] >= coverage)

    able = F.filter(kinds, lambda kind: F.size(F.array_except(kind["key"], F.col("has"))) == 0)
    matches = F.when(F.size("has") > 0, F.flatten(F.transform(able, matched))).otherwise(none)
    placed = held.select("doc_id", "n_words", matches.alias("matches"))
    base = F.filter("matches", lambda m: m["base"])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["start"].cast("long"))
    return placed.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"), F.col("matches"),
    )
