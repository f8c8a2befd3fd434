"""Documents joined by the Jaccard similarity of their word shingles.

The documents are the rows of a sparse incidence matrix, the shingles its columns,
and the product of the matrix with its transpose holds the overlap counts. Three
things keep the product small, none of which loses a link:

* Equal rows are one row (a class), whatever the number of copies.
* Columns are ordered from rare to frequent. Two rows that are similar enough share
  one of their first ``size - needed + 1`` columns, so only these enter the first product.
* A pair is dropped as soon as its sizes and the first shared column bound its overlap
  below what the threshold needs; and then if the parities of the two rows' hash bins
  differ in more places than the rows may.

The first product runs by blocks of columns and is taken with a few rows of each column,
the same for many columns, so it yields a bounded number of pairs per entry. Its verified links make
components; the second product then takes only pairs of a column that lie in
different components. For the pairs that are left the product goes on over all columns, block by block: the overlap counts
of the blocks are added up, and a pair is dropped as soon as what it has and the columns it still has ahead can't
reach the threshold.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendscore.llm.common import forgettable, mixed, removed, shipped, tidied, written_at
from spendscore.llm.components import connected
from spendscore.llm.filters import SLICES, member_filter, passing

#: Counters of the frequency sketch that orders the columns (a fixed size, 4 bytes each). It need only tell
#: frequent columns from others; the order among rare ones is that of their hashes at any size.
SKETCH_BITS = 18
#: Words whose hash is kept between rows; more are forgotten and hashed again.
WORD_CACHE = 100_000
#: Places of the filters that spare columns of one row, and texts of no pair, a shuffle (4 and 2 MB).
COLUMN_BITS, TEXT_BITS = 25, 24
#: Rows of a column that all its others are held against in the first product.
HUBS = 16
#: Blocks of columns, by their hashes, over which the overlaps of a pair are accumulated.
BLOCKS = 16


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()
forgettable(__name__, _WORDS.clear)


def _every_shingle(text: str | None, length: int) -> np.ndarray:
    """Hashes of the word shingles of a text, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    span = min(length, len(words))
    n = len(words) - span + 1
    with np.errstate(over="ignore"):
        total = np.full(n, span, np.uint64)
        for k in range(span):
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += hashes[k : n + k]
            total ^= total >> np.uint64(29)
    return mixed(total)


def shingles(text: str | None, length: int) -> np.ndarray:
    """Distinct hashes of the word shingles of a text, ascending.

    Words are runs of other characters than space and U+0009 to U+000D, A-Z lower-cased. A text with
    fewer words than ``length`` has its whole sequence as the one shingle, one
    without words has none.
    """
    return np.unique(_every_shingle(text, length))


def parities(own: np.ndarray) -> np.ndarray:
    """Of at least as many hash bins as the set has members: whether each holds an odd number.

    Two sets differ in at least as many members as their parities do in bins.
    """
    bins = max(64, 1 << int(len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


@tidied
def _sketched(batches, length: int, bits: int):
    """How often each counter is hit by the rows of this task, in slices."""
    counts = np.zeros(1 << bits, np.uint32)
    for pdf in batches:
        for start in range(0, len(pdf), 1000):
            hit = [_bucket(_every_shingle(text, length), bits) for text in pdf["text"].iloc[start : start + 1000]]
            at, n = np.unique(np.concatenate(hit), return_counts=True)
            counts[at] += n.astype(np.uint32)
    parts = [zlib.compress(part.tobytes(), 1) for part in np.array_split(counts, SLICES)]
    yield pd.DataFrame({"slice": range(SLICES), "counts": parts})


@tidied
def _added(batches):
    """The sums of the slices that reach this task, on a logarithmic scale of a byte."""
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        for k, data in zip(pdf["slice"], pdf["counts"]):
            part = np.frombuffer(zlib.decompress(data), np.uint32).astype(np.uint64)
            sums[k] = sums[k] + part if k in sums else part
    for k, part in sums.items():
        scaled = np.minimum(255, 8 * np.log2(1 + part.astype(np.float64))).astype(np.uint8)
        yield pd.DataFrame({"slice": [k], "counts": [scaled.tobytes()]})


def column_counts(docs: DataFrame, length: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """About how often every shingle occurs, by the top bits of its hash, on a logarithmic scale of a byte.

    Only the order of the columns follows from it: a crowded counter costs time, never a link.
    """
    sketched = docs.select("text").mapInPandas(
        functools.partial(_sketched, length=length, bits=bits), "slice int, counts binary"
    )
    rows = sketched.repartition(SLICES, "slice").mapInPandas(_added, "slice int, counts binary").collect()
    if not rows:
        return np.zeros(1 << bits, np.uint8)
    return np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in sorted(rows, key=lambda r: r["slice"])])


def _needed(size, percent: int):
    """The least overlap that a row of this size has with any similar row."""
    return -(-percent * size // 100)


def _objects(values: list) -> pd.Series:
    """A column of arrays or bytes, also of none."""
    return pd.Series(values, dtype=object)


@tidied
def _rows(batches, length: int, percent: int, bits: int, counts):
    """Per document: set size, a digest of the set, its rarest columns in order, and its parities."""
    frequency = counts.value
    for pdf in batches:
        sizes, digests, prefixes, odd = [], [], [], []
        for text in pdf["text"]:
            own = shingles(text, length)
            n = len(own)
            sizes.append(n)
            digests.append(xxhash.xxh128_digest(own.tobytes()) if n else None)
            if not n or _needed(n, percent) == n == 100 * n // percent:  # similar rows are equal rows
                prefixes.append(np.empty(0, np.int64))
                odd.append(np.empty(0, np.int64))
                continue
            keep = n - _needed(n, percent) + 1
            often = frequency[_bucket(own, bits)]
            few = np.flatnonzero(often <= np.partition(often, keep - 1)[keep - 1])
            rarest = few[np.lexsort((own[few], often[few]))[:keep]]
            prefixes.append(own[rarest].view(np.int64))
            odd.append(parities(own))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": sizes, "cls": digests, "prefix": _objects(prefixes), "odd": _objects(odd)})


@tidied
def _entries(batches, several):
    """The columns of each class that another class may have too, with their positions."""
    on = several.value
    for pdf in batches:
        prefixes = [np.asarray(p, np.int64) for p in pdf["prefix"]]
        at = [passing(on, p.view(np.uint64)) for p in prefixes]
        some = [i for i, k in enumerate(at) if len(k)]
        out = pdf[["cls", "doc_id", "n"]].iloc[some].reset_index(drop=True)
        out["col"] = _objects([prefixes[i][at[i]] for i in some])
        out["pos"] = _objects([at[i].astype(np.int32) for i in some])
        yield out


@tidied
def _sets(batches, length: int, wanted):
    """The whole sets of the documents whose ids pass the filter, cut into blocks of columns."""
    starts = np.arange(1, BLOCKS, dtype=np.uint64) << np.uint64(64 - (BLOCKS.bit_length() - 1))
    for pdf in batches:
        chosen = passing(wanted.value, pdf["hash"].to_numpy().view(np.uint64))
        sets = [shingles(text, length) for text in pdf["text"].iloc[chosen]]
        digests = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
        blocks = [[part.view(np.int64) for part in np.split(s, np.searchsorted(s, starts))] for s in sets]
        yield pd.DataFrame({"cls": _objects(digests), "n": [len(s) for s in sets], "blocks": _objects(blocks)})


def _fits(percent: int) -> str:
    """Whether rows x and y are similar enough, if this is the first column they share, for all that is known of it."""
    return (
        f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND "
        f"least(x.n - x.pos, y.n - y.pos) >= ceil({percent} * (x.n + y.n) / {100 + percent}.0)"
    )


def _parities_fit(percent: int) -> str:
    """Whether the parities of x and y differ in no more bins than similar sets may; the larger one is folded."""

    def folded(own: str, other: str) -> str:
        half = f"cast(size({own}.odd) / 2 AS int)"
        return (f"if(size({own}.odd) > size({other}.odd), zip_with(slice({own}.odd, 1, {half}), "
                f"slice({own}.odd, {half} + 1, {half}), (p, q) -> p ^ q), {own}.odd)")

    return (
        f"aggregate(zip_with({folded('x', 'y')}, {folded('y', 'x')}, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"
        f" <= x.n + y.n - 2 * ceil({percent} * (x.n + y.n) / {100 + percent}.0)"
    )


def _overlap(percent: int) -> str:
    """The overlap of rows a and b, accumulated block by block; -1 as soon as the blocks ahead can't bring it to what the sizes demand."""
    needed = f"ceil({percent} * (n_a + n_b) / {100 + percent}.0)"
    step = ("named_struct('both', p.both + size(array_intersect(b.x, b.y)), 'ahead_a', p.ahead_a - size(b.x), 'ahead_b', p.ahead_b - size(b.y))")
    return (
        "aggregate(zip_with(blocks_a, blocks_b, (x, y) -> named_struct('x', x, 'y', y)), "
        "named_struct('both', 0, 'ahead_a', n_a, 'ahead_b', n_b), "
        f"(p, b) -> if(p.both < 0 OR p.both + least(p.ahead_a, p.ahead_b) < {needed}, "
        f"named_struct('both', -1, 'ahead_a', 0, 'ahead_b', 0), {step}), p -> p.both)"
    )


PAIR = ("x.cls AS a", "y.cls AS b", "x.doc_id AS doc_a", "y.doc_id AS doc_b")


def _verified(pairs: DataFrame, docs: DataFrame, length: int, percent: int) -> tuple[DataFrame, str]:
    """The pairs (a, b) of classes that are similar enough, by their whole sets.

    ``pairs`` also names a document of each class, so that only texts of classes in a
    pair are cut into shingles again.
    """
    spark = docs.sparkSession
    if pairs.isEmpty():
        return written_at(pairs.select("a", "b"), "similar")
    ends, ends_at = written_at(
        pairs.select(F.col("a").alias("cls"), F.col("doc_a").alias("doc_id")).unionAll(
            pairs.select(F.col("b").alias("cls"), F.col("doc_b").alias("doc_id"))).distinct(),
        "ends",
    )
    of_id = F.xxhash64(F.col("doc_id").cast("long")).alias("hash")
    wanted = spark.sparkContext.broadcast(member_filter(ends.select(of_id), TEXT_BITS))
    sets, sets_at = written_at(
        docs.select(of_id, "text").mapInPandas(functools.partial(_sets, length=length, wanted=wanted), "cls binary, n int, blocks array<array<long>>")
        .join(ends.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"]),
        "sets",
    )
    wanted.destroy()
    of = lambda end: sets.select(F.col("cls").alias(end), F.col("n").alias(f"n_{end}"), F.col("blocks").alias(f"blocks_{end}"))
    links, links_at = written_at(
        pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
        .withColumn("both", F.expr(_overlap(percent)))
        .where(f"both >= 0 AND 100 * both >= {percent} * (n_a + n_b - both)")
        .select("a", "b"),
        "similar",
    )
    removed(spark, sets_at, ends_at)
    return links, links_at


def ngram_join(
    docs: DataFrame,
    length: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """Per document: ``id_col``, ``n_shingles`` and ``component_id``.

    Two documents link if 100 * intersection >= ``percent`` * union of their sets of
    ``length``-word shingles; ``component_id`` is the smallest id reachable by links.

    * NULL or wordless texts have an empty set and are components of their own.
    * Each row counts as a document: repeated rows link with each other as copies do, with or
      without equal ids. A NULL id never names a component unless it has no other.
    * An empty table gives no rows; further columns are ignored.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = shipped(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = spark.sparkContext.broadcast(column_counts(own, length, sketch_bits))
    rows, _ = written_at(
        own.mapInPandas(
            functools.partial(_rows, length=length, percent=percent, bits=sketch_bits, counts=counts),
            "doc_id string, n long, cls binary, prefix array<long>, odd array<long>",
        ).withColumn("doc_id", F.col("doc_id").cast("long")),
        "rows",
    )
    counts.destroy()
    classes, classes_at = written_at(
        rows.where("cls IS NOT NULL AND size(prefix) > 0").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("odd").alias("odd")),
        "classes",
    )
    several, several_at = written_at(
        classes.select(F.explode("prefix").alias("col")).groupBy("col").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("col"),
        "several",
    )
    # Columns of one row alone are left out before anything but their hashes is shuffled.
    on = spark.sparkContext.broadcast(member_filter(several.select(F.col("col").alias("hash")), COLUMN_BITS))
    shared, shared_at = written_at(
        classes.select("cls", F.col("doc_id").cast("string"), "n", "prefix")
        .mapInPandas(functools.partial(_entries, several=on), "cls binary, doc_id string, n long, col array<long>, pos array<int>")
        .select("cls", F.col("doc_id").cast("long").alias("doc_id"), "n", F.explode(F.arrays_zip("col", "pos")).alias("e"))
        .select("cls", "doc_id", "n", "e.*").join(several, "col"),
        "shared",
    )
    on.destroy()
    # The same hubs for many columns: the classes whose digests come first. Ranks are cut before the shuffle.
    turn = F.row_number().over(Window.partitionBy("col").orderBy("cls"))
    hubs, hubs_at = written_at(shared.withColumn("turn", turn).where(F.col("turn") <= HUBS).drop("turn"), "hubs")
    odd = lambda end: classes.select(F.col("cls").alias(end), F.struct("n", "odd").alias(f"_{end}"))

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs whose parities fit."""
        fit = _parities_fit(percent).replace("x.", "_a.").replace("y.", "_b.")
        return pairs.join(odd("a"), "a").join(odd("b"), "b").where(fit).select("a", "b", "doc_a", "doc_b")

    star, star_at = written_at(
        shared.alias("y").join(hubs.alias("x"), "col").where("x.cls < y.cls AND " + _fits(percent)).selectExpr(*PAIR).distinct(),
        "star-pairs",
    )
    pairs, pairs_at = written_at(near(star), "near-star-pairs")
    links, links_at = _verified(pairs, own, length, percent)
    roots = connected(links)
    # What is left: pairs of a column in different components, the hubs' own pairs being done.
    placed, placed_at = written_at(
        shared.join(hubs.select("col", "cls"), ["col", "cls"], "left_anti")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")),
        "placed",
    )
    open_columns, open_at = written_at(
        placed.groupBy("col").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("col"), "open-columns")
    rest, rest_at = written_at(
        placed.join(open_columns, "col", "left_semi").join(classes.select("cls", "odd"), "cls"), "open-entries")
    more_pairs, more_at = written_at(
        rest.alias("x").join(rest.alias("y"), "col")
        .where(f"x.cls < y.cls AND x.root <> y.root AND {_fits(percent)} AND {_parities_fit(percent)}").selectExpr(*PAIR).distinct(),
        "more-pairs",
    )
    more, found_at = _verified(more_pairs, own, length, percent)
    if not more.isEmpty():
        links, _ = written_at(links.unionAll(more), "all-links")
        roots = connected(links)
    by_class = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"))
    placed_classes, _ = written_at(
        by_class.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls")),
        "placed-classes",
    )
    names = placed_classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named, _ = written_at(placed_classes.join(names, "root").select("cls", "component_id"), "named")
    removed(spark, classes_at, several_at, shared_at, hubs_at, star_at, pairs_at, links_at, placed_at, open_at, rest_at, more_at, found_at)
    return rows.join(named, "cls", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
