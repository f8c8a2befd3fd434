"""Benchmark passages in documents, found by spaced seeds.

A mask of care and ignore positions slides over the words. The hash of the words at
its care positions is the same whatever stands at the ignored ones. The masks are chosen so
that a passage shares a seed with the benchmark wherever the words lie that were replaced, up to the number
tolerated. Hashes of documents and items are joined; around each hit the words are compared one by one.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import forgettable, mixed, removed, shipped, tidied, written_at
from spendscore.llm.filters import member_filter, passing

#: Bits of the filter that keeps documents without any hit from being shuffled (a fixed 8 MB).
FILTER_BITS = 26
WORD_CACHE = 100_000
#: Words of a passage up to which masks are searched for.
SEARCHED = 13
# Words: A-Z lower-cased, other ASCII signs than letters and digits are gaps.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()
forgettable(__name__, _WORDS.clear)


def tokens(text: str | None) -> np.ndarray:
    """The hashes of the words of a text, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


@functools.lru_cache(maxsize=64)
def spaced_masks(length: int, misses: int, most: int = 4) -> tuple[str, ...]:
    """Masks of which one at least fits between any ``misses`` replaced words of ``length``.

    The heaviest masks, greedily chosen, of which ``most`` suffice. Beyond SEARCHED words the
    number of masks is too large to search: the longest run that always remains is the mask.
    """
    if length > SEARCHED:
        return ("1" * -(-(length - misses) // (misses + 1)),)
    gaps = [frozenset(c) for c in combinations(range(length), misses)]
    for weight in range(length - misses, 0, -1):
        covers = {}
        for span in range(weight, length + 1):
            ends = (0, span - 1) if weight > 1 else (0,)
            for inner in combinations(range(1, max(1, span - 1)), weight - len(ends)):
                care = tuple(sorted({*ends, *inner}))
                shifts = [frozenset(x + o for x in care) for o in range(length - span + 1)]
                covers[care] = frozenset(k for k, g in enumerate(gaps) if any(not s & g for s in shifts))
        left, chosen = set(range(len(gaps))), []
        while left and len(chosen) < most and covers[best := max(sorted(covers), key=lambda c: len(covers[c] & left))] & left:
            chosen.append("".join("1" if k in best else "0" for k in range(best[-1] + 1)))
            left -= covers[best]
        if not left:
            return tuple(chosen)
    return ("1",)


def tolerated(length: int, percent: int) -> int:
    """How many of ``length`` words may differ."""
    return length - -(-length * percent // 100)


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash at every position where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, xxhash.xxh64_intdigest(mask), np.uint64)
    with np.errstate(over="ignore"):
        for k, care in enumerate(mask):
            if care == "1":
                total += words[k : k + n] * np.uint64(xxhash.xxh64_intdigest(f"{mask}:{k}") | 1)
    return mixed(total)


@tidied
def _item_rows(batches):
    for pdf in batches:
        words = [tokens(t) for t in pdf["text"]]
        yield pd.DataFrame({
            "item_id": pdf["item_id"], "n": [len(w) for w in words], "words": [w.view(np.int64) for w in words],
            "item": [xxhash.xxh128_hexdigest(w.tobytes()) for w in words],
        })


@tidied
def _seed_rows(batches, window: int, percent: int):
    """Every seed of every item."""
    for pdf in batches:
        for item, words in zip(pdf["item"], pdf["words"]):
            words = np.asarray(words, np.int64).view(np.uint64)
            span = min(window, len(words))
            for mask in spaced_masks(span, tolerated(span, percent)):
                found = seeds(words, mask)
                yield pd.DataFrame({
                    "hash": found.view(np.int64), "item": item, "at": np.arange(len(found), dtype=np.int32), "n": len(words),
                })


@tidied
def _hits(batches, masks, places):
    """Documents with at least one seed in the filter: their words and such seeds."""
    on = places.value
    for pdf in batches:
        out = []
        for doc, mark, text in zip(pdf["doc"], pdf["mark"], pdf["text"]):
            words = tokens(text)
            found = []
            for mask in masks:
                own = seeds(words, mask)
                at = passing(on, own)
                found.append((at, own[at]))
            if any(len(a) for a, _ in found):
                where = np.concatenate([a for a, _ in found])
                out.append((doc, mark, words.view(np.int64), where.astype(np.int32),
                            np.concatenate([h for _, h in found]).view(np.int64)))
        yield pd.DataFrame(out, columns=["doc", "mark", "words", "at", "hash"])


def _best(equal: np.ndarray, span: int) -> tuple[int, int]:
    """The most equal words in ``span`` neighbouring places, and where they start."""
    sums = np.concatenate([[0], np.cumsum(equal)])
    inside = sums[span:] - sums[:-span]
    start = int(inside.argmax())
    return int(inside[start]), start


@tidied
def _compared(batches, window: int):
    """Per candidate alignment: the best window of equal words."""
    for pdf in batches:
        out = []
        for doc, mark, item, shift, ours, theirs in pdf[["doc", "mark", "item", "shift", "part", "words"]].itertuples(index=False):
            theirs, lead = np.asarray(theirs), max(0, -shift)
            equal = np.zeros(len(theirs), np.int64)
            ours = np.asarray(ours)
            equal[lead : lead + len(ours)] = ours == theirs[lead : lead + len(ours)]
            span = min(window, len(theirs))
            most, start = _best(equal, span)
            out.append((doc, mark, item, shift + start, most, span, int(equal.sum()), len(theirs)))
        yield pd.DataFrame(out, columns=["doc", "mark", "item", "start", "n_equal", "span", "n_equal_item", "n_item"])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    percent: int = 80,
    min_words: int = 5,
) -> DataFrame:
    """One row per document and benchmark item of which it holds a passage.

    A passage is ``window`` consecutive words of the item (all, if it has fewer) of which
    ``percent`` % at least stand in the document at the same distances. Columns:
    ``id_col``, ``item_id_col``, ``start`` (the passage's first word in the document, from 0),
    ``n_equal`` of ``span`` words there, ``overlap`` (their ratio), ``n_equal_item`` of
    ``n_item`` words of the whole item at that alignment.

    * NULL and wordless texts hold nothing. Items with fewer than ``min_words`` words are no evidence.
    * Items with equal words are compared once and listed each; repeated rows and such with
      equal id are one each if their texts are equal, else the best alignment counts.
    * An empty table on either side gives no rows; further columns are ignored.
    """
    spark = shipped(docs.sparkSession)
    items, items_at = written_at(
        benchmark.select(F.col(item_id_col).cast("string").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
        .mapInPandas(_item_rows, "item_id string, n int, words array<long>, item string")
        .where(F.col("n") >= min_words),
        "items",
    )
    distinct, distinct_at = written_at(items.groupBy("item").agg(F.first("words").alias("words"), F.first("n").alias("n")), "distinct-items")
    index, index_at = written_at(
        distinct.mapInPandas(functools.partial(_seed_rows, window=window, percent=percent), "hash long, item string, at int, n int"), "seeds"
    )
    places = spark.sparkContext.broadcast(member_filter(index, FILTER_BITS))
    spans = [r["span"] for r in distinct.select(F.least("n", F.lit(window)).alias("span")).distinct().collect()]
    masks = sorted({mask for span in spans for mask in spaced_masks(span, tolerated(span, percent))})
    hits, hits_at = written_at(
        docs.select(F.col(id_col).cast("string").alias("doc"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).cast("string").alias("text"))
        .mapInPandas(
            functools.partial(_hits, masks=masks, places=places),
            "doc string, mark long, words array<long>, at array<int>, hash array<long>",
        ),
        "hits",
    )
    places.destroy()
    single = hits.select("doc", "mark", F.explode(F.arrays_zip("at", "hash")).alias("h")).select("doc", "mark", "h.*")
    aligned, aligned_at = written_at(
        single.withColumnRenamed("at", "place").join(index, "hash")
        .select("doc", "mark", "item", "n", (F.col("place") - F.col("at")).alias("shift")).distinct(),
        "alignments",
    )
    # The document's words beside the item's, cut to the alignment.
    first = F.greatest(F.lit(0), F.col("shift"))
    part = F.slice("words", first + 1, F.greatest(F.lit(0), F.least(F.size("words"), F.col("shift") + F.col("n")) - first))
    beside = aligned.join(hits.select("doc", "mark", "words"), ["mark"]).where(aligned["doc"].eqNullSafe(hits["doc"])).select(
        aligned["doc"], "mark", "item", "shift", part.alias("part")
    ).distinct()
    found, _ = written_at(
        beside.join(distinct.select("item", "words"), "item")
        .mapInPandas(
            functools.partial(_compared, window=window),
            "doc string, mark long, item string, start int, n_equal int, span int, n_equal_item int, n_item int",
        )
        .where(F.col("n_equal") * 100 >= F.col("span") * percent)
        .groupBy("doc", "item")
        .agg(F.max(F.struct("n_equal", "n_equal_item", (-F.col("start")).alias("back"), "span", "n_item")).alias("b")),
        "passages",
    )
    listed, _ = written_at(items.select("item", "item_id").distinct(), "item-ids")
    removed(spark, items_at, distinct_at, index_at, hits_at, aligned_at)
    return found.join(listed, "item").select(
        F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("item_id").cast(benchmark.schema[item_id_col].dataType).alias(item_id_col), (-F.col("b.back")).alias("start"),
        "b.n_equal", "b.span", (F.col("b.n_equal") / F.col("b.span")).alias("overlap"), "b.n_equal_item", "b.n_item",
    )
