"""Toxicity by a learned, weighted lexicon matched with Aho-Corasick.

Texts are folded first: case, accents, look-alike letters of other scripts, and
digits or signs that stand for letters. Entries are whole words or word beginnings, with a
weight learned from labelled rows. Each word of a text counts with its heaviest
entry unless an exception phrase covers it; the sum over the length is the score.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import forgettable, held_out, in_training, removed, shipped, tidied, written, written_at
from spendscore.llm.filters import member_filter, passing, split_by_keys

# Letters of other scripts that look like Latin ones, and signs used for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "з": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}
#: Phrases in which a word of the lexicon means no harm.
EXCEPTIONS = (
    "clown fish", "pathetic fallacy", "trash can", "trash bin", "idiot light", "pond scum", "loser tree",
    "stupid question", "idiot proof",
)
#: Lengths of word beginnings that may become entries.
STEMS = range(5, 10)
#: A candidate occurs in so many toxic rows, whatever their number.
LEAST_ROWS = 4
#: An entry is this many times as frequent in toxic rows as in others, also if its ratio is lowered by so many of its
#: standard errors: what a few rows may have by chance is no entry.
LEAST_RATIO, ERRORS = 8.0, 1.64
#: Entries beyond which there is an error, since the lexicon is sent to all tasks.
MOST_ENTRIES = 1_000_000
#: Bits of the filter that spares other entries of clean rows a shuffle (a fixed 4 MB).
FILTER_BITS = 25
#: Added to the length, so that one bad word in three doesn't outweigh the whole.
EXTRA_WORDS = 10
#: The score at the boundary between the classes.
BOUNDARY = 0.3
BINS = 400

_FOLD = str.maketrans({**HOMOGLYPHS, **DIGITS})
_SIGN = re.compile(r"[@$!|€](?=\w)")
_OTHER = re.compile(r"[^a-z]+")
_MARKS = {c: None for c in range(0x300, 0x370)}


def folded(text: str | None) -> str:
    """The words of a text in a-z alone, each with a space before and after."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_MARKS)
    text = _SIGN.sub(lambda m: SIGNS[m[0]], text).translate(_FOLD)
    words = _OTHER.sub(" ", text).strip()
    return f" {words} " if words else ""


def _entries(text: str | None) -> set[str]:
    """Candidate entries of a text: its words, and beginnings of longer ones."""
    words = set(folded(text).split())
    found = {f" {w} " for w in words if len(w) > 2}
    for w in words:
        found.update(f" {w[:k]}" for k in STEMS if k < len(w))
    return found


def _rows_of(counts: Counter[str], on: np.ndarray | None) -> pd.DataFrame:
    """Counts with the entries' hashes; with a filter, of what passes it."""
    entries = [*counts]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, entries), np.uint64, len(entries))
    chosen = range(len(entries)) if on is None else passing(on, hashes)
    entries = [entries[k] for k in chosen]
    return pd.DataFrame({"entry": pd.Series(entries, dtype=object), "n": pd.Series([counts[e] for e in entries], dtype="int64"),
                         "hash": hashes[list(chosen)].view(np.int64)})


@tidied
def _counted(batches, wanted):
    """How many texts of this task have each entry; of all entries, or those that pass a filter."""
    on = wanted.value if wanted is not None else None
    counts: Counter[str] = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            counts.update(_entries(text))
        if len(counts) > 300_000:
            yield _rows_of(counts, on)
            counts = Counter()
    yield _rows_of(counts, on)


def learned_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Weights of entries from rows of (text, toxic).

    Candidates and their counts in clean rows meet in a join; the driver gets the entries that pass the ratio alone.
    """
    spark = labelled.sparkSession
    sizes = {r["toxic"]: r["n"] for r in labelled.where("toxic IN (0, 1)").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)

    def count(label: int, wanted=None) -> DataFrame:
        rows = labelled.where(F.col("toxic") == label).select("text")
        parts = rows.mapInPandas(functools.partial(_counted, wanted=wanted), "entry string, n long, hash long")
        return parts.groupBy("entry").agg(F.sum("n").alias("n"), F.min("hash").alias("hash"))

    bad, bad_at = written_at(count(1).where(F.col("n") >= LEAST_ROWS), "candidates")
    on = spark.sparkContext.broadcast(member_filter(bad, FILTER_BITS))
    good = count(0, on).select("entry", F.col("n").alias("clean"))
    often, seldom = F.col("n") + 0.5, F.coalesce("clean", F.lit(0)) + 0.5
    ratio = F.log(often / (toxic + 1)) - F.log(seldom / (clean + 1))
    sure = ratio - ERRORS * F.sqrt(1 / often + 1 / seldom) >= math.log(LEAST_RATIO)
    passed, passed_at = written_at(bad.join(good, "entry", "left").where(sure).select("entry", ratio.alias("weight")), "lexicon")
    on.destroy()
    if (entries := passed.count()) > MOST_ENTRIES:
        raise ValueError(f"{entries} entries pass the ratio; a lexicon has {MOST_ENTRIES} at most")
    weights = {r["entry"]: r["weight"] for r in passed.collect()}
    removed(spark, bad_at, passed_at)
    return weights


class Matcher:
    """The automaton of a lexicon and its exceptions."""

    def __init__(self, lexicon: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (entry, weight))
        for phrase in EXCEPTIONS:
            self.automaton.add_word(f" {phrase} ", (f" {phrase} ", None))
        self.automaton.make_automaton()

    def feature(self, text: str | None) -> tuple[float, int]:
        """Weight per word, and the number of words that match."""
        line = folded(text)
        heaviest: dict[int, float] = {}
        excused: set[int] = set()
        for end, (entry, weight) in self.automaton.iter(line):
            start = end - len(entry) + 1
            if weight is None:
                excused.update(i for i in range(start, end) if line[i] == " ")
            elif weight > heaviest.get(start, 0):
                heaviest[start] = weight
        found = [w for start, w in heaviest.items() if start not in excused]
        return sum(found) / (max(line.count(" ") - 1, 0) + EXTRA_WORDS), len(found)


@functools.lru_cache(maxsize=2)
def _matcher(lexicon: tuple[tuple[str, float], ...]) -> Matcher:
    return Matcher(dict(lexicon))


forgettable(__name__, _matcher.cache_clear)


@tidied
def _features(batches, lexicon):
    matcher = _matcher(lexicon.value)
    for pdf in batches:
        found = [matcher.feature(t) for t in pdf["text"]]
        yield pd.DataFrame({
            "id": pdf["id"], "held_out": pdf["held_out"], "feature": [x[0] for x in found], "n_matched": [x[1] for x in found],
        })


def boundary(labelled: DataFrame) -> float:
    """The feature value that tells toxic rows of (feature, toxic) best from others, by their histograms."""
    top = labelled.agg(F.max("feature")).first()[0] or 1.0
    rows = labelled.groupBy(F.floor(F.col("feature") / top * BINS).alias("bin")).agg(
        F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).collect()
    bins = {r["bin"]: (r["toxic"], r["n"] - r["toxic"]) for r in rows}
    missed, wrong = 0, sum(clean for k, (_, clean) in bins.items() if k > 0)
    missed = bins.get(0, (0, 0))[0]
    # The middle of the best cuts: between the classes there are usually many.
    best, ties = None, []
    for cut in range(1, BINS + 1):
        error = missed + wrong
        if best is None or error < best:
            best, ties = error, [cut]
        elif error == best:
            ties.append(cut)
        toxic, clean = bins.get(cut, (0, 0))
        missed, wrong = missed + toxic, wrong - clean
    return (ties[0] + ties[-1]) / 2 / BINS * top


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score``, ``predicted`` and ``n_matched`` words.

    Lexicon and boundary are learned from the labelled rows that are not held out; with
    ``predicted`` 1 from a score of 0.3 on.

    * NULL and wordless texts score 0, and so does everything if no row is labelled toxic. Texts of any length are scored whole.
    * Ties: of equally good boundaries the middle one is taken; of entries at one place the heaviest counts.
    * Labels other than 0 and 1 are ignored; an id labelled twice counts as often.
    * Repeated rows get equal results; rows without id are held out and scored.
    * An empty table gives no rows; further columns are ignored.
    """
    spark = shipped(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(in_training(id_col) & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    labelled, _ = split_by_keys(own, known, F.xxhash64("id"), F.xxhash64("id"))
    lexicon = learned_lexicon(written(labelled.join(known.hint("merge"), "id").select("text", "toxic"), "labelled"))
    entries = spark.sparkContext.broadcast(tuple(sorted(lexicon.items())))
    kind = docs.schema[id_col].dataType.simpleString()
    features = written(
        own.select(F.col("id").cast("string").alias("id"), held_out("id").alias("held_out"), "text").mapInPandas(
            functools.partial(_features, lexicon=entries), "id string, held_out boolean, feature double, n_matched int"
        ).withColumn("id", F.col("id").cast(kind)),
        "features",
    )
    cut = boundary(features.select("id", "feature").join(known, "id"))
    scale = cut * (1 - BOUNDARY) / BOUNDARY
    score = F.col("feature") / (F.col("feature") + F.lit(float(scale))) if lexicon and scale > 0 else F.lit(0.0)
    return features.select(
        F.col("id").alias(id_col), "held_out", score.cast("double").alias("score"),
        (score >= BOUNDARY).cast("int").alias("predicted"), "n_matched",
    )
