"""Licence notices by a positional index of rare words, on built-in expressions only.

Each notice is a template of words with a mandatory key phrase. Texts are cut into words once; which licence
words a text has is kept, and the words themselves of texts that have all words of some key phrase. The
document frequency of the licence words is counted over all documents. The index lists, for each word, the templates and
the offsets in their key phrases that it stands at. Of every file the licence words of highest inverse document frequency
are looked up, as many for each template that the file may hold; what their postings
say about where the key phrase starts is intersected, and at the starts that are left
the whole key phrase must stand. The share of the template's other words that stand around it is the score.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import written_at

#: Words of each key phrase that are looked up: the file's rarest ones.
LOOKED_UP = 2
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A notice: its label, its words and its key phrase."""

    label: str
    words: str
    key: str
    base: bool = False

    @property
    def key_start(self) -> int:
        return f" {self.words} "[: f" {self.words} ".index(f" {self.key} ")].count(" ")


# Notices as they are usually worded, in lower case.
TEMPLATES = (
    Template("gpl", "licensed under the gnu general public license", "gnu general public license", True),
    Template("apache", "licensed under the apache license", "apache license", True),
    Template("cc-by", "licensed under cc by", "cc by", True),
    Template("mit", "released under the mit license", "mit license", True),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("cc-by", "licensed under a creative commons attribution", "creative commons attribution"),
    Template("cc0", "creative commons zero", "creative commons zero"),
    Template("cc0", "licensed under cc0 1 0", "cc0 1 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("epl", "the eclipse public license", "eclipse public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             "permission to use copy modify and or distribute this software"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("mpl-2.0", "the mozilla public license version 2 0", "mozilla public license"),
    Template("unlicense", "free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """Words of a text: runs of letters, digits and signs beyond ASCII, A-Z lower-cased."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), capitals, capitals.lower()), F.lit(WORDS), F.lit(0))


def _strings(values) -> Column:
    return F.array(*map(F.lit, values))


def _keys(templates: tuple[Template, ...]) -> Column:
    return F.array(*[_strings(t.key.split()) for t in templates])


def _possible(present: Column, templates: tuple[Template, ...]) -> Column:
    """The numbers of the templates all of whose key words are in the text."""
    each = F.transform(_keys(templates), lambda key, k: F.when(F.size(F.array_except(key, present)) == 0, k))
    return F.when(F.size(present) > 0, F.array_compact(each)).otherwise(F.array().cast("array<int>"))


def document_frequency(scanned: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows each word of the vocabulary occurs: one count a word at most."""
    rows = scanned.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    return {w: 0 for w in vocabulary} | {r["word"]: r["n"] for r in rows}


def _index(templates: tuple[Template, ...]) -> Column:
    """Word -> postings (template, offset in its key phrase); a word's first offset stands for all."""
    postings: dict[str, list[Column]] = {}
    for k, template in enumerate(templates):
        key = template.key.split()
        for word in dict.fromkeys(key):
            postings.setdefault(word, []).append(F.struct(F.lit(k).alias("template"), F.lit(key.index(word)).alias("offset")))
    return F.create_map(*[x for word, listed in sorted(postings.items()) for x in (F.lit(word), F.array(*listed))])


def _chosen(often: dict[str, int], templates: tuple[Template, ...]) -> Column:
    """Per possible template of a row, the file's rarest words of its key phrase, from the highest inverse document frequency.

    ``ranked`` holds all licence words in this order; those that the file lacks are passed over.
    """
    ranked = _strings(sorted(often, key=lambda w: (often[w], -len(w), w)))
    own = F.filter(ranked, lambda w: F.array_contains("present", w))
    keys = _keys(templates)
    return F.transform("possible", lambda k: F.struct(
        k.alias("template"), F.slice(F.filter(own, lambda w: F.array_contains(F.get(keys, k), w)), 1, LOOKED_UP).alias("rare")))


def _proposed(templates: tuple[Template, ...]) -> tuple[Column, Column]:
    """The chosen words, and what their postings say: (template, word, start of the key phrase) for every place of each."""
    looked_up = F.array_distinct(F.flatten(F.transform("chosen", lambda c: c["rare"])))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: F.array_contains("looked_up", h["word"]))
    index = _index(templates)
    return looked_up, F.flatten(F.transform(hits, lambda h: F.transform(
        F.element_at(index, h["word"]),
        lambda p: F.struct(p["template"].alias("template"), h["word"].alias("word"), (h["at"] - p["offset"]).alias("start")))))


def _starts(k: int, template: Template) -> Column:
    """Where the key phrase starts, once per place: starts that all looked-up words agree on, then the phrase itself."""
    rare = F.element_at(F.transform(F.filter("chosen", lambda c: c["template"] == k), lambda c: c["rare"]), 1)

    def said_by(word: Column) -> Column:
        mine = F.filter("proposed", lambda p: (p["template"] == k) & (p["word"] == word))
        return F.transform(mine, lambda p: p["start"])

    agreed = F.aggregate(F.slice(rare, 2, LOOKED_UP), F.array_distinct(said_by(F.get(rare, F.lit(0)))),
                         lambda starts, word: F.array_intersect(starts, said_by(word)))
    key = template.key.split()
    whole = F.filter(agreed, lambda s: (s >= 0) & (F.slice("words", F.greatest(s, F.lit(0)) + 1, len(key)) == _strings(key)))
    return F.when(F.array_contains("possible", k), whole).otherwise(F.array().cast("array<int>"))


def _coverage(template: Template, places: Column, words: Column) -> Column:
    """The largest share of the template's words that stand where it lays them."""
    own = template.words.split()
    lead = template.key_start

    def share(start: Column) -> Column:
        fits = [F.when(F.get(words, start + (j - lead)) == w, 1).otherwise(0) for j, w in enumerate(own)]
        return sum(fits[1:], fits[0]) / F.lit(len(own))

    return F.coalesce(F.array_max(F.transform(places, share)), F.lit(0.0))


def license_scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``n_base`` counts the places of all base key phrases, ``first_word`` and ``last_word`` are the least and
    the largest start (words from 0). ``labels`` adds those of the other templates whose
    key phrase stands in the text; ``score`` is the largest share of a found template's words, 0 without any.

    * NULL and wordless texts have 0 words, no places, empty label lists and score 0. Texts of any length are scanned whole.
    * Ties: of equally rare words the longer one, then the first by name is looked up; which one changes no result.
    * Repeated rows are scanned each. An empty table gives no rows; further columns are ignored.
    """
    vocabulary = sorted({w for t in templates for w in t.key.split()})
    cut = docs.select(F.col(f"`{id_col}`").alias("doc"), words_of(F.col(f"`{text_col}`").cast("string")).alias("words"))
    found = cut.select("doc", "words", F.array_intersect("words", _strings(vocabulary)).alias("present"))
    possible = found.withColumn("possible", _possible(F.col("present"), templates))
    kept = F.when(F.size("possible") > 0, F.col("words"))
    scanned, _ = written_at(possible.select("doc", F.size("words").cast("long").alias("n_words"), "present", "possible", kept.alias("words")), "licence-words")
    often = document_frequency(scanned, vocabulary)
    looked_up, proposed = _proposed(templates)
    none = F.array().cast("array<struct<template:int,word:string,start:int>>")
    asked = (
        scanned.withColumn("chosen", _chosen(often, templates)).withColumn("looked_up", looked_up)
        .withColumn("proposed", F.when(F.col("words").isNotNull(), proposed).otherwise(none))
    )
    numbers = range(len(templates))
    found = asked.select("doc", "n_words", "words", *[_starts(k, templates[k]).alias(f"t{k}") for k in numbers])
    base = [k for k in numbers if templates[k].base]
    starts = F.flatten(F.array(*[F.col(f"t{k}") for k in base]))

    def labels(chosen) -> Column:
        each = F.array(*[F.when(F.size(f"t{k}") > 0, F.lit(templates[k].label)) for k in chosen])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(each))), ",")

    return found.select(
        F.col("doc").alias(id_col),
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(numbers).alias("labels"),
        F.greatest(*[_coverage(templates[k], F.col(f"t{k}"), F.col("words")) for k in numbers]).alias("score"),
    )
