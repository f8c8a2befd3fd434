"""Text quality by an interpolated modified Kneser-Ney model of trusted text.

Labels err, so the trusted documents with the least likely words are not learned from.
The n-grams of all words of trusted text are counted, without a bound on the vocabulary, and
kept as a table by hash of the n-gram, in buckets of packed numbers. A small model over frequent words and word shapes (runs of letters, digits,
signs) stands below the single words. Documents are gathered into pieces; the distinct
n-grams of a piece are sent to the buckets, and the piece is scored by what comes back. Both go share by share, so that
little of it is on disk at a time. Texts are cut into words once for it; what is counted, asked and scored are packed numbers
and hashes of a batch's different words. Documents are held against
their language's quantile of the perplexity of trusted documents that were not counted.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.llm.common import in_training, mixed, removed, settled, shipped, shuffles_removed, written, written_at
from spendscore.llm.filters import split_by_keys
from spendscore.sources.workdir import work_dir

#: Numbered words and shapes, at most VOCABULARY^3 trigrams (8 MB of floats); of them so many shapes, which
#: occur in this share of the trusted documents.
VOCABULARY, SHAPES, LEAST_SHARE = 128, 32, 0.02
#: What a document starts and ends with, and any shape without a number.
EDGE, OTHER = "<edge>", "<other>"
#: The share of trusted documents of a language that a threshold must let pass.
QUANTILE = 0.95
#: The threshold is this many times the quantile, and for a text of n words e^(SHORT / sqrt(n)) times that.
SLACK, SHORT = 1.3, 2.5
#: The share of trusted documents, by the likelihood of their single words, that is not learned from.
TRIMMED = 0.08
WORD_CACHE = 100_000
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: One trusted document in so many is not counted but measures the thresholds.
MEASURED = 5
#: Documents that are looked up together: at most so many, and no more once they have so many characters.
PIECE_DOCS, PIECE_CHARS = 2000, 2_000_000
#: N-grams are counted in so many shares at most, one more for every so many characters of trusted text; documents are scored in slices alike.
SHARES, SHARE_CHARS, SLICES, SLICE_CHARS = 6, 8_000_000, 8, 25_000_000
#: Buckets of n-grams: at least so many, and one for every so many characters of trusted text.
LEAST_BUCKETS, BUCKET_CHARS = 32, 4_000_000
#: Word trigrams that a task gathers before it sends them on.
FLUSHED = 2_000_000
#: Keys that are looked up at once.
LOOKED_UP = 2_000_000
_RUN = re.compile(r"(.)\1+", re.DOTALL)


#: What stands for each ASCII character in a shape.
_KINDS = {k: "a" if chr(k).islower() else "A" if chr(k).isupper() else "0" if chr(k).isdigit() else chr(k) for k in range(128)}


@functools.lru_cache(maxsize=WORD_CACHE)
def _short(kinds: str) -> str:
    return "~" + _RUN.sub(r"\1", kinds)


def shape(word: str) -> str:
    """A word with runs of letters as a or A, of digits as 0 and of any other sign as one."""
    if word.isalpha() and word.islower():
        return "~a"
    if word.isascii():
        return _short(word.translate(_KINDS))
    kinds = "".join("a" if c.islower() else "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _short(kinds)


#: What stands for each character in a shape, found when it is first met.
_KIND = np.full(0x110000, 0xFFFFFFFF, np.uint32)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins in the bytes of all words, and where the last ends; and these bytes."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return at - at[0], data[at[0]:at[-1]]


def shapes(words: pa.Array) -> pa.Array:
    """``shape`` of each word, without the leading sign."""
    words = words.cast(pa.large_string())
    if not len(words):
        return words
    codes = np.frombuffer(_letters(words)[1].tobytes().decode().encode("utf-32-le"), np.uint32)
    kinds = _KIND[codes]
    if len(new := np.flatnonzero(kinds == 0xFFFFFFFF)):
        for code in np.unique(codes[new]).tolist():
            _KIND[code] = ord(shape("\u00e9" + chr(code))[-1]) if code > 127 else ord(_KINDS[code])
        kinds = _KIND[codes]
    ends = np.cumsum(pc.utf8_length(words).to_numpy())
    first = np.append(0, ends[:-1])
    stays = np.append(True, kinds[1:] != kinds[:-1])
    stays[first] = True
    wide = stays * (1 + (kinds > 0x7F) + (kinds > 0x7FF) + (kinds > 0xFFFF))
    offsets = np.append(0, np.cumsum(np.add.reduceat(wide, first)))
    data = kinds[stays].tobytes().decode("utf-32-le").encode()
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(data))


def numbered(words: pa.Array, vocabulary: tuple[str, ...]) -> np.ndarray:
    """The number of each word, or of its shape."""
    words = words.cast(pa.large_string())
    own = pc.index_in(words, pa.array(vocabulary, pa.large_string()))
    out = own.fill_null(1).to_numpy().astype(np.int64)
    other = np.flatnonzero(own.is_null().to_numpy(zero_copy_only=False))
    found = shapes(words.take(pa.array(other))).dictionary_encode()
    known = {w: k for k, w in enumerate(vocabulary)}
    numbers = np.array([known.get("~" + x, 1) for x in found.dictionary.to_pylist()], np.int64)
    out[other] = numbers[found.indices.to_numpy()]
    return out


def hashed(words: pa.Array) -> np.ndarray:
    """A hash of each word: its length and, eight at a time, its bytes mixed together."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.empty(0, np.uint64)
    at, data = _letters(words)
    data = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    size = np.diff(at)
    out = mixed(size.astype(np.uint64))
    some = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    for k in range(0, LONG_WORD, 8):
        rest = np.minimum(size[some] - k, 8).astype(np.uint64)
        part = eight[at[some] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest))
        out[some] = mixed(out[some] ^ part)
        some = some[size[some] > k + 8]
        if not len(some):
            break
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(words[k].as_py())
    return out


#: What stands for the edge among hashes of words.
EDGE_HASH = hashed(pa.array([EDGE + "\0"]))


class _Numbers(dict):
    """Numbers of words, found once."""

    def __init__(self, vocabulary: list[str]):
        super().__init__({w: k for k, w in enumerate(vocabulary)})
        self.known = dict(self)

    def __missing__(self, word: str) -> int:
        if len(self) > WORD_CACHE:
            self.clear()
            self.update(self.known)
        self[word] = number = self.known.get(shape(word), 1)
        return number


@functools.lru_cache(maxsize=2)
def _numbers(vocabulary: tuple[str, ...]) -> _Numbers:
    return _Numbers(list(vocabulary))


def trigrams(text: str | None, numbers: _Numbers, width: int) -> np.ndarray:
    """The numbers of the word trigrams of a text, two edges before it and one after."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64)
    ids = np.zeros(len(words) + 3, np.int64)
    ids[2:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    return (ids[:-2] * width + ids[1:-1]) * width + ids[2:]


def _in_texts(codes: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """In how many texts each of ``size`` numbers occurs; ``n`` are the texts' lengths."""
    pairs = _different(np.repeat(np.arange(len(n)), n) * size + codes)
    return np.bincount(pairs % size, minlength=size) if size else np.empty(0, np.int64)


_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _word_counts(batches):
    """In how many texts of this task each word and each shape occurs."""
    settled()
    tables, size = [], 0

    def summed():
        counts = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        return pa.table([counts["word"], counts["n_sum"]], schema=_COUNTED)

    for batch in batches:
        words = Words(batch.column("text"))
        n = _in_texts(words.at, words.n, len(words.words))
        tables.append(pa.table([words.words.cast(pa.string()), n], schema=_COUNTED).filter(pc.invert(pc.starts_with(words.words, "~"))))
        kinds = shapes(words.words).cast(pa.string()).dictionary_encode()
        n = _in_texts(kinds.indices.to_numpy()[words.at], words.n, len(kinds.dictionary))
        tables.append(pa.table([pc.binary_join_element_wise("~", kinds.dictionary, ""), n], schema=_COUNTED))
        size += len(tables[-2]) + len(tables[-1])
        if size > 1_000_000:  # rare words leave early and are added up later
            counts = summed()
            yield from counts.filter(pc.less(counts["n"], 20)).to_batches()
            tables = [counts.filter(pc.greater_equal(counts["n"], 20))]
            size = len(tables[0])
    if tables:
        yield from summed().to_batches()


def _untrimmed(batch: pa.RecordBatch, words: Words, symbols: np.ndarray, trim) -> np.ndarray:
    """The texts with words that ``trim`` (log probabilities of words, limits by language) does not drop."""
    surprises = _surprise(words, symbols, trim[0])
    return np.array([x is not None and x <= trim[1].get(lang, np.inf) for lang, x in zip(batch.column("lang").to_pylist(), surprises)], bool)


def _surprise(words: Words, symbols: np.ndarray, logs: np.ndarray) -> list[float | None]:
    """Mean surprise of each text's single words."""
    logs = logs[symbols[words.starts + 2]]
    return [float(-logs[end - n:end].mean()) if n else None for n, end in zip(words.grams.tolist(), words.ends.tolist())]


def _gram_counts(batches, vocabulary, width: int, trim):
    """Trigrams of this task's texts but those that ``trim`` drops."""
    total = np.zeros(width**3, np.int64)
    for batch in batches:
        words = Words(batch.column("text"))
        ids = words.symbols(vocabulary)
        at = words.starts
        if trim is not None:
            at = at[np.repeat(_untrimmed(batch, words, ids, trim), words.grams)]
        grams, n = np.unique((ids[at] * width + ids[at + 1]) * width + ids[at + 2], return_counts=True)
        total[grams] += n
    some = np.flatnonzero(total)
    yield pa.record_batch({"gram": some, "n": total[some]})


def vocabulary_of(trusted: DataFrame, size: int = VOCABULARY) -> tuple[tuple[str, ...], int]:
    """The words and shapes with a number, and how many shapes have none.

    The most frequent of all trusted text, by documents.
    """
    counts, counts_at = written_at(
        trusted.select("text").mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    is_shape, order = F.col("word").startswith("~"), (F.desc("n"), "word")
    least = LEAST_SHARE * trusted.count()
    shapes = [r["word"] for r in counts.where(is_shape & (F.col("n") >= least)).orderBy(*order).limit(SHAPES).collect()]
    words = [r["word"] for r in counts.where(~is_shape).orderBy(*order).limit(size - 2 - SHAPES).collect()]
    others = max(1, counts.where(is_shape).count() - len(shapes))
    removed(trusted.sparkSession, counts_at)
    return (EDGE, OTHER, *shapes, *words), others


def discounts(tallies: list[int]) -> list[float]:
    """Discounts of n-grams that occur once, twice, and more often, from how many occur one to four times."""
    n1, n2, n3, n4 = (max(1, n) for n in tallies)
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3))]


def _discounts(counts: DataFrame) -> list[float]:
    often = counts.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    return discounts([n or 0 for n in often])


def _order(counts: DataFrame, lower: DataFrame | None, width: int, shared: str) -> DataFrame:
    """(gram, p) and the context's weight ``g`` for one order, from its counts (gram, n).

    ``shared`` gives the n-gram of the lower order that continues it.
    """
    d1, d2, d3 = _discounts(counts)
    cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    context = F.floor(F.col("gram") / width).alias("context")
    sums = counts.groupBy(context).agg(F.sum("n").alias("all"), F.sum(cut).alias("cut"))
    own = counts.select("*", context).join(sums, "context").select(
        "gram", "context", ((F.col("n") - cut) / F.col("all")).alias("own"), (F.col("cut") / F.col("all")).alias("g"))
    if lower is None:
        return own.select("gram", "context", (F.col("own") + F.col("g") / width).alias("p"), "g")
    return (
        own.withColumn("below", F.expr(shared)).join(lower.select(F.col("gram").alias("below"), F.col("p").alias("q")), "below")
        .select("gram", "context", (F.col("own") + F.col("g") * F.col("q")).alias("p"), "g")
    )


def kneser_ney(trusted: DataFrame, vocabulary: tuple[str, ...], others: int = 1, trim=None) -> np.ndarray:
    """Log probability of every trigram, as a table of a size that the vocabulary fixes.

    A word without a number is one of ``others`` shapes and pays for which.
    """
    width = len(vocabulary)
    paths: list[str] = []

    def kept(df: DataFrame, purpose: str) -> DataFrame:
        out, path = written_at(df, purpose)
        paths.append(path)
        return out

    three = kept(
        trusted.select("lang", "text")
        .mapInArrow(functools.partial(_gram_counts, vocabulary=vocabulary, width=width, trim=trim), "gram long, n long")
        .groupBy("gram").agg(F.sum("n").alias("n")),
        "trigrams",
    )
    # Lower orders count the different words before an n-gram, not its occurrences.
    two = kept(three.groupBy(F.expr(f"gram % {width * width}").alias("gram")).agg(F.count(F.lit(1)).alias("n")), "bigrams")
    one = kept(two.groupBy(F.expr(f"gram % {width}").alias("gram")).agg(F.count(F.lit(1)).alias("n")), "unigrams")
    p1 = kept(_order(one, None, width, ""), "p1")
    p2 = kept(_order(two, p1, width, f"gram % {width}"), "p2")
    p3 = kept(_order(three, p2, width, f"gram % {width * width}"), "p3")
    first, second, third = (p.select("gram", "context", "p", "g").toPandas() for p in (p1, p2, p3))
    removed(trusted.sparkSession, *paths)
    unigram = np.full(width, (first["g"].iloc[0] if len(first) else 1.0) / width)
    unigram[first["gram"]] = first["p"]
    weight = np.ones(width)
    weight[second["context"]] = second["g"]
    bigram = (weight[:, None] * unigram[None, :]).ravel()
    bigram[second["gram"]] = second["p"]
    weight = np.ones(width * width)
    weight[third["context"]] = third["g"]
    trigram = (weight.reshape(width, width, 1) * bigram.reshape(1, width, width)).ravel()
    trigram[third["gram"]] = third["p"]
    trigram.reshape(-1, width)[:, vocabulary.index(OTHER)] /= others
    return np.log(trigram).astype(np.float32)


def _unigram_counts(batches, vocabulary):
    """In how many texts of this task each word occurs."""
    total = np.zeros(len(vocabulary), np.int64)
    for batch in batches:
        words = Words(batch.column("text"))
        total += _in_texts(words.symbols(vocabulary)[words.starts + 2], words.grams, len(vocabulary))
    yield pa.record_batch({"word": np.arange(len(vocabulary)), "n": total})


def _surprises(batches, vocabulary, logs):
    """Mean surprise of each text's single words."""
    for batch in batches:
        words = Words(batch.column("text"))
        found = _surprise(words, words.symbols(vocabulary), logs)
        yield pa.record_batch({"lang": batch.column("lang"), "surprise": pa.array(found, pa.float64())})


def trimming(trusted: DataFrame, vocabulary: tuple[str, ...], trimmed: float = TRIMMED) -> tuple[np.ndarray, dict[str | None, float]]:
    """Log probabilities of the vocabulary's words, and by language the mean surprise beyond which a text isn't learned from."""
    rows = trusted.select("text").mapInArrow(functools.partial(_unigram_counts, vocabulary=vocabulary), "word long, n long")
    counts = np.ones(len(vocabulary))
    for row in rows.groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[row["word"]] += row["n"]
    logs = np.log(counts / counts.sum())
    judged = trusted.select("lang", "text").mapInArrow(
        functools.partial(_surprises, vocabulary=vocabulary, logs=logs), "lang string, surprise double").where("surprise IS NOT NULL")
    limits = judged.groupBy("lang").agg(F.percentile_approx("surprise", 1 - trimmed, 10_000).alias("most")).collect()
    return logs, {r["lang"]: r["most"] for r in limits}


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers as compressed bytes, the lowest byte of each first; ``rising`` ones as differences."""
    values = np.ascontiguousarray(values).astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    wide = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.empty((wide, len(values)), np.uint8)
    for k in range(wide):
        planes[k] = values >> np.uint64(8 * k)
    return bytes([wide]) + len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    wide, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], decompressed_size=wide * size, codec="zstd", asbytes=True), np.uint8).reshape(wide, size)
    values = planes[0].astype(np.uint64)
    for k in range(1, wide):
        values |= planes[k].astype(np.uint64) << np.uint64(8 * k)
    return np.cumsum(values, dtype=np.uint64) if rising else values


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each different one of sorted values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def _different(values: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    values = np.sort(values)
    return values[_firsts(values)]


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, sorted; a place of each; how often each occurs."""
    order = np.argsort(values)
    values = values[order]
    first = _firsts(values)
    return values[first], order[first], np.diff(np.append(first, len(values)))


def _added(n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of the stretches that begin at ``first``."""
    return np.add.reduceat(n.astype(np.uint64), first) if len(n) else np.empty(0, np.uint64)


def _joined(parts, rising: bool = False) -> np.ndarray:
    """The numbers of a column of packed ones."""
    parts = [unpacked(x, rising) for x in parts.to_pylist() if x is not None]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _stacked(parts, rows: int) -> np.ndarray:
    """As many rows of numbers, of a column of such packed row after row."""
    parts = [unpacked(x).reshape(rows, -1) for x in parts.to_pylist() if x is not None]
    return np.concatenate(parts, axis=1) if parts else np.empty((rows, 0), np.uint64)


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of five numbers as which of the different columns each is, and these, the most frequent first."""
    mark = np.zeros(values.shape[1], np.uint64)
    for row in values:
        mark = mixed(mark ^ row)
    order = np.argsort(mark)
    first = _firsts(mark[order])
    n = np.diff(np.append(first, len(mark)))
    rank = np.argsort(-n, kind="stable")
    place = np.empty(len(n), np.int64)
    place[rank] = np.arange(len(n))
    codes = np.empty(len(mark), np.int64)
    codes[order] = np.repeat(place, n)
    kinds = values[:, order[first[rank]]]
    if not (kinds[:, codes] == values).all():  # two columns with one mark
        kinds, codes = np.unique(values, axis=1, return_inverse=True)
    return codes.ravel(), kinds


def _decoded(codes, kinds) -> tuple[np.ndarray, np.ndarray]:
    """What ``_coded`` gave, of columns of packed ones."""
    at, tables, size = [np.empty(0, np.int64)], [np.empty((5, 0), np.uint64)], 0
    for code, kind in zip(codes.to_pylist(), kinds.to_pylist()):
        if code is not None:
            at.append(unpacked(code).view(np.int64) + size)
            tables.append(unpacked(kind).reshape(5, -1))
            size += tables[-1].shape[1]
    return np.concatenate(at), np.concatenate(tables, axis=1)


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, rising with the key."""
    return ((keys >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted keys begins, and where the last ends."""
    least = ((np.arange(buckets) << 16) + buckets - 1) // buckets
    return np.append(np.searchsorted(keys, least.astype(np.uint64) << np.uint64(48)), len(keys))


class Slots:
    """Texts as numbers of words, one text after another: ``n`` of each text; ``at``, which of the different words each is; their ``hashes``.

    Two edges stand before a text with words and one after.
    """

    def __init__(self, n: np.ndarray, at: np.ndarray, hashes: np.ndarray | None = None):
        self.n, self.at, self._hashes = n, at, hashes
        some = self.n > 0
        slots = np.where(some, self.n + 3, 0)
        first = np.cumsum(slots) - slots
        self.slots = int(slots.sum())
        self.places = np.arange(len(self.at)) + np.repeat(first + 2 - (np.cumsum(self.n) - self.n), self.n)
        #: Trigrams of each text, and where all of them begin.
        self.grams = np.where(some, self.n + 1, 0)
        self.ends = np.cumsum(self.grams)
        self.starts = np.arange(int(self.grams.sum())) + np.repeat(first - (self.ends - self.grams), self.grams)

    def spread(self, values: np.ndarray, edge) -> np.ndarray:
        """A value for each slot from those of the different words."""
        out = np.full(self.slots, edge, values.dtype)
        out[self.places] = values[self.at]
        return out

    def hashes(self) -> np.ndarray:
        """Hashes of the different words and, last, of the edge."""
        return np.append(self._hashes, EDGE_HASH)

    def keys(self) -> dict[str, np.ndarray]:
        """Keys of every word's n-grams: of trigrams, ``three``; by slot of bigrams, ``two`` (that of the slot and the next), and of the different words, ``one``.

        A trigram's context is the bigram where it begins, and a bigram follows at the next slot. The key of a trigram begins as
        that of its context, so that both are in one bucket.
        """
        hashes = self.hashes()
        ids, first = (self.spread(x[:-1], x[-1]) for x in (hashes, mixed(hashes + np.uint64(2))))
        # The key of n words: each is mixed into the key of those before it.
        two = mixed(first[:-1] ^ ids[1:])
        context = two[self.starts]
        three = mixed((context + np.uint64(3)) ^ ids[self.starts + 2])
        return {"three": (context >> np.uint64(48) << np.uint64(48)) | (three >> np.uint64(16)), "two": two, "one": mixed(hashes + np.uint64(1))}

    def bigrams(self) -> np.ndarray:
        """Slots where bigrams begin that are the context or the end of a trigram."""
        used = np.zeros(max(0, self.slots - 1), bool)
        used[self.starts] = used[self.starts + 1] = True
        return np.flatnonzero(used)


class Words(Slots):
    """The different ``words`` of some texts, and where they stand."""

    def __init__(self, texts: pa.Array):
        trimmed = pc.utf8_trim_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        empty = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
        lists = pc.utf8_split_whitespace(trimmed)
        flat = lists.flatten()
        flat = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
        self.words = flat.dictionary
        super().__init__(np.where(empty, 0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64), flat.indices.to_numpy())

    def hashes(self) -> np.ndarray:
        return np.append(hashed(self.words), EDGE_HASH)

    def symbols(self, vocabulary: tuple[str, ...]) -> np.ndarray:
        """The numbers of the words in each slot."""
        return self.spread(numbered(self.words, vocabulary), 0)


def _in_share(words: Slots, buckets: int, share: int, shares: int) -> tuple[np.ndarray, ...]:
    """Of the texts' trigrams those whose context is in this share, as (context, key), and those whose last bigram is, as (bigram, key, first, last)."""
    keys = words.keys()
    at, rows = words.starts, keys["three"]
    mine = buckets_of(keys["two"], buckets) % shares == share
    above, below = np.flatnonzero(mine[at]), np.flatnonzero(mine[at + 1])
    one = words.spread(keys["one"][:-1], keys["one"][-1])
    ends = at[below] + 1
    return keys["two"][at[above]], rows[above], keys["two"][ends], rows[below], one[ends], one[ends + 1]


def _gram_rows(found: list[tuple[np.ndarray, ...]], buckets: int):
    """A row for each bucket: trigrams under their contexts, and under the bigrams that end them."""
    c2, k3, k2, ends, c1, k1 = (np.concatenate(x) for x in zip(*found))
    k3, first, n = _grouped(k3)
    order = np.argsort(c2[first])
    c2, k3, n = c2[first][order], k3[order], n[order]
    ends, first, _ = _grouped(ends)
    order = np.argsort(k2[first])
    first = first[order]
    k2, ends, c1, k1 = k2[first], ends[order], c1[first], k1[first]
    cuts, cuts2 = _cuts(c2, buckets), _cuts(k2, buckets)
    for b in range(buckets):
        above, below = slice(cuts[b], cuts[b + 1]), slice(cuts2[b], cuts2[b + 1])
        pairs, at, times = _grouped(k2[below])
        if above.start < above.stop or len(pairs):
            yield {
                "bucket": b, "c2": packed(c2[above], True), "k3": packed(k3[above]), "n": packed(n[above]), "k2": packed(pairs, True),
                "times": packed(times), "ends": packed(ends[below]), "c1": packed(c1[below][at]), "k1": packed(k1[below][at])}


_LEARNED = pa.schema([("n", pa.binary()), ("at", pa.binary()), ("hashes", pa.binary()), ("chars", pa.int64())])


def _learned(batches, vocabulary, trim):
    """The texts with words that ``trim`` does not drop, as numbers and hashes of their words."""
    for batch in batches:
        texts = batch.column("text")
        words = Words(texts)
        learned = _untrimmed(batch, words, words.symbols(vocabulary), trim)
        at = words.at[np.repeat(learned, words.n)]
        used = np.zeros(len(words.words), bool)
        used[at] = True
        chars = pc.sum(pc.utf8_length(texts.filter(pa.array(learned)))).as_py() or 0
        row = {"n": packed(words.n[learned]), "at": packed((np.cumsum(used) - 1)[at]), "hashes": packed(words.hashes()[:-1][used]), "chars": chars}
        yield pa.RecordBatch.from_pylist([row], _LEARNED)


def _word_gram_counts(batches, buckets: int, share: int, shares: int):
    """Word trigrams of this task's texts, gathered into a row for each bucket of a share."""
    schema = pa.schema([("bucket", pa.int32()), *[(name, pa.binary()) for name in ("c2", "k3", "n", "k2", "times", "ends", "c1", "k1")]])
    settled()
    found, size = [], 0
    for batch in batches:
        for n, at, hashes in zip(*(batch.column(name).to_pylist() for name in ("n", "at", "hashes"))):
            words = _slots(n, at, hashes)
            if len(words.starts):
                found.append(_in_share(words, buckets, share, shares))
                size += len(found[-1][0]) + len(found[-1][2])
            if size >= FLUSHED:
                yield from _batches(_gram_rows(found, buckets), schema)
                found, size = [], 0
    if found:
        yield from _batches(_gram_rows(found, buckets), schema)


def _batches(rows, schema: pa.Schema):
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], schema)


def _tallies(n: np.ndarray) -> list[int]:
    """How many of ``n`` are 1, 2, 3 and 4."""
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _by_context(contexts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different contexts; for each the sum of ``n``, and how often it is 1, 2 and more."""
    order = np.argsort(contexts)
    contexts, n = contexts[order], n[order]
    first = _firsts(contexts)
    return contexts[first], np.array([_added(x, first) for x in (n, n == 1, n == 2, n > 2)])


def _entries(ends: np.ndarray, n: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys with a count as n-grams (``n``) or as contexts (``counts``), and five numbers of each."""
    keys = _different(np.concatenate([ends, contexts]))
    values = np.zeros((5, len(keys)), np.uint64)
    values[0, np.searchsorted(keys, ends)] = n
    values[1:, np.searchsorted(keys, contexts)] = counts
    return keys, values


MODEL = ("keys3", "n3", "keys2", "codes2", "kinds2", "keys1", "codes1", "kinds1")
_BLOBS = "bucket int, " + ", ".join(f"{name} binary" for name in (*MODEL[:6], "values1"))
_GRAMS = pa.schema([("bucket", pa.int32()), *[(name, pa.binary()) for name in (*MODEL[:6], "values1")],
                    ("tallies3", pa.list_(pa.int64())), ("tallies2", pa.list_(pa.int64()))])


def _bucket_counts(rows: pa.Table) -> pa.Table:
    """The entries of a bucket's trigrams and bigrams; those of words as far as this bucket tells."""
    k3, n, c2 = _joined(rows["k3"]), _joined(rows["n"]), _joined(rows["c2"], True)
    order = np.argsort(k3)
    first = _firsts(k3[order])
    n3, first = _added(n[order], first), order[first]
    keys3 = k3[first]
    # Lower orders count the different words before an n-gram, as in ``kneser_ney``.
    pairs = _joined(rows["k2"], True)
    once = _grouped(_joined(rows["ends"]))[1]
    k2, _, n2 = _grouped(np.repeat(pairs, _joined(rows["times"]).view(np.int64))[once])
    at = _grouped(pairs)[1]
    k1, _, n1 = _grouped(_joined(rows["k1"])[at])
    keys2, values2 = _entries(k2, n2, *_by_context(c2[first], n3))
    keys1, values1 = _entries(k1, n1, *_by_context(_joined(rows["c1"])[at], n2))
    codes2, kinds2 = _coded(values2)
    return pa.Table.from_pylist([{
        "bucket": rows["bucket"][0].as_py(), "keys3": packed(keys3, True), "n3": packed(n3), "keys2": packed(keys2, True), "codes2": packed(codes2),
        "kinds2": packed(kinds2.ravel()), "keys1": packed(keys1, True), "values1": packed(values1.ravel()), "tallies3": _tallies(n3), "tallies2": _tallies(n2)}],
        _GRAMS)


_PARTS = pa.schema([("bucket", pa.int32()), ("keys1", pa.binary()), ("values1", pa.binary())])


def _word_parts(batches, buckets: int):
    """What the buckets of n-grams tell of words, by the words' own bucket."""
    for batch in batches:
        for keys, values in zip(batch.column("keys1").to_pylist(), batch.column("values1").to_pylist()):
            keys, values = unpacked(keys, True), unpacked(values).reshape(5, -1)
            cuts = _cuts(keys, buckets)
            rows = [{"bucket": b, "keys1": packed(keys[x:y], True), "values1": packed(values[:, x:y].ravel())}
                    for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _PARTS)


def _word_sums(rows: pa.Table) -> pa.Table:
    """The entries of a bucket's words."""
    keys, at = np.unique(_joined(rows["keys1"], True), return_inverse=True)
    values = np.array([np.bincount(at, x, len(keys)) for x in _stacked(rows["values1"], 5)]).astype(np.uint64)
    n = values[0][values[0] > 0]
    codes, kinds = _coded(values)
    return pa.Table.from_pylist(
        [{"bucket": rows["bucket"][0].as_py(), "keys1": packed(keys, True), "codes1": packed(codes), "kinds1": packed(kinds.ravel()),
          "tallies": [*_tallies(n), len(n), int(n.sum())]}],
        pa.schema([("bucket", pa.int32()), *[(name, pa.binary()) for name in MODEL[5:]], ("tallies", pa.list_(pa.int64()))]))


def _summed(df: DataFrame, column: str, size: int) -> list[int]:
    row = df.agg(*[F.sum(F.col(column)[k]) for k in range(size)]).first()
    return [n or 0 for n in row]


class WordModel:
    """The table of all word n-grams of trusted text, with what holds for all of it.

    Rows are buckets of keys: trigrams with their counts; bigrams and words with the number of different words before them and, as
    contexts, the sum of counts of what continues them and how many of these are 1, 2 and more (as codes: most have the numbers of many others). The table is bucketed, so that
    lookups don't shuffle it again.
    """

    def __init__(self, trusted: DataFrame, trusted_at: str, vocabulary: tuple[str, ...], trim):
        spark = trusted.sparkSession
        learned, learned_at = written_at(
            trusted.select("lang", "text").mapInArrow(functools.partial(_learned, vocabulary=vocabulary, trim=trim), "n binary, at binary, hashes binary, chars long"), "learned")
        removed(spark, trusted_at)
        chars = learned.agg(F.sum("chars")).first()[0] or 0
        self.buckets = min(1 << 16, max(LEAST_BUCKETS, chars // BUCKET_CHARS))
        shares = min(SHARES, 1 + chars // SHARE_CHARS)
        blobs = ", ".join(f"{name} binary" for name in ("c2", "k3", "n", "k2", "times", "ends", "c1", "k1"))
        tables = []
        for share in range(shares):
            count = functools.partial(_word_gram_counts, buckets=self.buckets, share=share, shares=shares)
            tables.append(written_at(
                learned.select("n", "at", "hashes").mapInArrow(count, f"bucket int, {blobs}")
                .groupBy("bucket").applyInArrow(_bucket_counts, f"{_BLOBS}, tallies3 array<long>, tallies2 array<long>"), "word-grams"))
        removed(spark, learned_at)
        grams = functools.reduce(DataFrame.unionByName, [df for df, _ in tables])
        words, words_at = written_at(
            grams.select("keys1", "values1").mapInArrow(functools.partial(_word_parts, buckets=self.buckets), "bucket int, keys1 binary, values1 binary")
            .groupBy("bucket").applyInArrow(_word_sums, "bucket int, keys1 binary, codes1 binary, kinds1 binary, tallies array<long>"), "word-sums")
        *tallies, self.words, total = _summed(words, "tallies", 6)
        self.cuts = [discounts(x) for x in (tallies, _summed(grams, "tallies2", 4), _summed(grams, "tallies3", 4))]
        self.total = float(total or 1)
        d1, d2, d3 = self.cuts[0]
        cut = d1 * tallies[0] + d2 * tallies[1] + d3 * (self.words - tallies[0] - tallies[1])
        self.below, self.words = (cut / total, self.words) if total else (1.0, 1)
        self.name, self.path = f"word_model_{uuid.uuid4().hex}", work_dir(spark, "word-model")
        for df, path in [*tables, (words.drop("tallies"), words_at)]:
            rows = df.select("bucket", *[(F.col(x) if x in df.columns and (x[-1] == "1") == (path == words_at) else F.lit(None).cast("binary")).alias(x)
                                         for x in MODEL])
            rows.write.bucketBy(self.buckets, "bucket").option("path", self.path).format("parquet").mode("append").saveAsTable(self.name)
            removed(spark, path)
        self.table = spark.table(self.name)

    def known(self) -> dict:
        """What is needed to score besides the table."""
        return {"below": float(self.below), "words": int(self.words), "total": self.total, "cuts": self.cuts}

    def remove(self) -> None:
        spark = self.table.sparkSession
        spark.sql(f"DROP TABLE {self.name}")
        removed(spark, self.path)


PIECES = "piece string, ids array<string>, langs array<string>, n binary, at binary, hashes binary, symbols binary"
_PIECES = pa.schema([("piece", pa.string()), ("ids", pa.list_(pa.string())), ("langs", pa.list_(pa.string())),
                     *[(name, pa.binary()) for name in ("n", "at", "hashes", "symbols")]])


def _pieces(batches, vocabulary):
    """Documents gathered into pieces, a row each, their texts as numbers, hashes and symbols of their words."""
    settled()
    parts, docs, chars = [], 0, 0

    def piece():
        ids, langs, texts = (pa.concat_arrays([x.column(name) for x in parts]) for name in ("id", "lang", "text"))
        words = Words(texts)
        row = {"piece": uuid.uuid4().hex, "ids": ids.to_pylist(), "langs": langs.to_pylist(), "n": packed(words.n), "at": packed(words.at),
               "hashes": packed(words.hashes()[:-1]), "symbols": packed(numbered(words.words, vocabulary))}
        return pa.RecordBatch.from_pylist([row], _PIECES)

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy())
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = min(first + PIECE_DOCS - docs, int(np.searchsorted(ends, before + PIECE_CHARS - chars)) + 1, len(ends))
            parts.append(batch.slice(first, last - first))
            docs, chars, first = docs + last - first, chars + int(ends[last - 1] - before), last
            if docs >= PIECE_DOCS or chars >= PIECE_CHARS:
                yield piece()
                parts, docs, chars = [], 0, 0
    if parts:
        yield piece()


def _slots(n: bytes, at: bytes, hashes: bytes) -> Slots:
    """Texts of packed numbers."""
    return Slots(unpacked(n).view(np.int64), unpacked(at).view(np.int64), unpacked(hashes))


_ASKED = pa.schema([("in_bucket", pa.int32()), ("piece", pa.string()), ("asked3", pa.binary()), ("asked2", pa.binary()), ("asked1", pa.binary())])


def _asked(batches, buckets: int):
    """The different keys of each piece, a row for each bucket."""
    settled()
    for batch in batches:
        for piece, n, at, hashes in zip(*(batch.column(name).to_pylist() for name in ("piece", "n", "at", "hashes"))):
            words = _slots(n, at, hashes)
            keys = words.keys()
            orders = [(x, _cuts(x, buckets)) for x in map(_different, (keys["three"], keys["two"][words.bigrams()], keys["one"] if len(words.at) else keys["one"][:0]))]
            rows = ({"in_bucket": b, "piece": piece} | {f"asked{3 - k}": packed(keys[cuts[b]:cuts[b + 1]], True) for k, (keys, cuts) in enumerate(orders)}
                    for b in range(buckets) if any(cuts[b] < cuts[b + 1] for _, cuts in orders))
            yield from _batches(rows, _ASKED)


_ANSWERS = pa.schema([("of_piece", pa.string()), ("bucket", pa.int32()), *[(name, pa.binary()) for name in ("n3", "codes2", "kinds2", "codes1", "kinds1")]])
ANSWERS = "of_piece string, bucket int, n3 binary, codes2 binary, kinds2 binary, codes1 binary, kinds1 binary"


def _places(keys: np.ndarray, wanted: list[np.ndarray]) -> list[np.ndarray]:
    """Where in sorted keys those of each list are; behind the last if nowhere."""
    every = np.concatenate(wanted)
    order = np.argsort(every)  # one way through the keys for all lists
    every = every[order]
    at = np.searchsorted(keys, every)
    if len(keys):
        at[keys[np.minimum(at, len(keys) - 1)] != every] = len(keys)
    out = np.empty(len(order), np.int64)
    out[order] = at
    return np.split(out, np.cumsum([len(x) for x in wanted])[:-1])


def _answers(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The numbers of a bucket's keys for each piece that asks, in its order; 0 for a key that was never seen."""
    keys3, n3 = _joined(model["keys3"], True), np.append(_joined(model["n3"]), np.uint64(0))
    tables = []
    for order in "21":
        codes, kinds = _decoded(model[f"codes{order}"], model[f"kinds{order}"])
        tables.append((order, _joined(model[f"keys{order}"], True), np.append(codes, kinds.shape[1]), np.pad(kinds, ((0, 0), (0, 1)))))
    out, rows, size = [], [], 0

    def answer():
        found = [{"of_piece": row["piece"], "bucket": row["in_bucket"]} for row in rows]
        for row, at in zip(found, _places(keys3, [row["asked3"] for row in rows])):
            row["n3"] = packed(n3[at])
        for order, keys, codes, kinds in tables:
            for row, at in zip(found, _places(keys, [row[f"asked{order}"] for row in rows])):
                own = codes[at]
                used = np.zeros(kinds.shape[1], bool)
                used[own] = True
                row |= {f"codes{order}": packed((np.cumsum(used) - 1)[own]), f"kinds{order}": packed(kinds[:, used].ravel())}
        out.extend(found)

    for row in zip(*(asked[name].to_pylist() for name in _ASKED.names)):
        row = dict(zip(_ASKED.names, row))
        rows.append(row | {name: unpacked(row[name], True) for name in _ASKED.names[2:]})
        size += sum(len(rows[-1][name]) for name in _ASKED.names[2:])
        if size >= LOOKED_UP:
            answer()
            rows, size = [], 0
    if rows:
        answer()
    return pa.Table.from_pylist(out, _ANSWERS)


def _scored(pieces: pa.Table, answers: pa.Table, vocabulary, table, below: float, words: int, total: float, cuts) -> pa.Table:
    """Perplexities of a piece's documents, from the counts of its keys."""
    logs, width = table.value, len(vocabulary)
    of_shape = np.array([w.startswith("~") or w == OTHER for w in vocabulary])
    answers = answers.sort_by("bucket")  # as the keys are sorted

    def less(n, cut):
        return n - np.where(n == 1, cut[0], np.where(n == 2, cut[1], np.where(n > 2, cut[2], 0.0)))

    def weight(values, cut):
        """What a context's words leave to the next lower order, and the sum of their counts."""
        every = np.maximum(values[1], 1)
        return np.where(values[1] > 0, ((cut[0] * values[2] + cut[1] * values[3] + cut[2] * values[4]) / every).astype(np.float32), 1.0), every

    out = []
    for row in pieces.to_pylist():
        found = _slots(row["n"], row["at"], row["hashes"])
        keys = found.keys()
        n3 = _joined(answers["n3"])
        (two, kinds2), (one, kinds1) = (_decoded(answers[f"codes{order}"], answers[f"kinds{order}"]) for order in "21")
        kinds2, kinds1 = kinds2.astype(np.float64), kinds1.astype(np.float64)
        ids = found.spread(unpacked(row["symbols"]).view(np.int64), 0)
        at, first = found.starts, found.bigrams()
        ids = (ids[at] * width + ids[at + 1]) * width + ids[at + 2]
        # Below the single words: the symbol's probability, shared by the words of a shape.
        p = np.exp(logs[ids].astype(np.float64)) / np.where(of_shape[ids % width], words, 1)
        if len(at):
            # Which of the answers' numbers each slot's word and its bigram have, and where each trigram is.
            word = one[np.unique(keys["one"], return_inverse=True)[1]]
            word = found.spread(word[:-1], word[-1])
            pair = np.zeros(found.slots, np.int64)
            pair[first] = two[np.unique(keys["two"][first], return_inverse=True)[1]]
            w1, all1 = weight(kinds1, cuts[1])
            w2, all2 = weight(kinds2, cuts[2])
            p = (less(kinds1[0], cuts[0]) / total).astype(np.float32)[word[at + 2]].astype(np.float64) + below * p
            p = (less(kinds2[0], cuts[1])[pair[at + 1]] / all1[word[at + 1]]).astype(np.float32).astype(np.float64) + w1[word[at + 1]] * p
            n3 = less(np.arange(int(n3.max()) + 1.0), cuts[2])[n3] if n3.max() < len(n3) else less(n3.astype(np.float64), cuts[2])
            triple = np.unique(keys["three"], return_inverse=True)[1]
            p = (n3[triple] / all2[pair[at]]).astype(np.float32).astype(np.float64) + w2[pair[at]] * p
        logs_of = np.log(p)
        for doc, lang, n, end in zip(row["ids"], row["langs"], found.grams.tolist(), found.ends.tolist()):
            out.append((doc, lang, n, float(np.exp(-logs_of[end - n:end].mean())) if n else None))
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table(dict(zip(_SCORED.names, columns)), _SCORED)


_SCORED = pa.schema([("id", pa.string()), ("lang", pa.string()), ("n", pa.int32()), ("perplexity", pa.float64())])


def perplexities(own: DataFrame, model: WordModel, vocabulary: tuple[str, ...], table) -> DataFrame:
    """(id, lang, n, perplexity) of all documents, slice after slice, so that only a slice's keys are on disk at a time."""
    spark = own.sparkSession
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = min(SLICES, 1 + chars // SLICE_CHARS)
    parts = []
    rows = own.select(F.col("id").cast("string").alias("id"), "lang", "text")
    in_slice = F.pmod(F.xxhash64(F.lit("slice"), F.coalesce("id", F.lit(""))), F.lit(slices))
    for k in range(slices):
        pieces, pieces_at = written_at(
            rows.where(in_slice == k).mapInArrow(functools.partial(_pieces, vocabulary=vocabulary), PIECES), "pieces")
        asked = pieces.select("piece", "n", "at", "hashes").mapInArrow(
            functools.partial(_asked, buckets=model.buckets), "in_bucket int, piece string, asked3 binary, asked2 binary, asked1 binary")
        answers = asked.groupBy("in_bucket").cogroup(model.table.groupBy("bucket")).applyInArrow(
            _answers, ANSWERS)
        parts.append(written(
            pieces.groupBy("piece").cogroup(answers.groupBy("of_piece")).applyInArrow(
                functools.partial(_scored, vocabulary=vocabulary, table=table, **model.known()), "id string, lang string, n int, perplexity double"),
            "perplexities"))
        removed(spark, pieces_at)
    return functools.reduce(DataFrame.unionByName, parts)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    label_col: str = "quality",
    quantile: float = QUANTILE,
    slack: float = SLACK,
    size: int = VOCABULARY,
) -> DataFrame:
    """Per row: ``id_col``, ``perplexity``, ``threshold`` and ``kept``.

    Trusted text is that of training rows labelled 1; a fifth of it is not counted but measures. A row is kept if its perplexity is
    at most ``slack`` times the ``quantile`` of its language's measuring rows; languages without any
    go by the quantile of all.

    * NULL and wordless texts have no perplexity and are not kept.
    * Without trusted text there is no threshold, and every text with words is kept.
    * Repeated rows get equal results; an id labelled twice counts as often.
    * An empty table gives no rows; further columns are ignored.
    """
    spark: SparkSession = shipped(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = labels.where(in_training(id_col) & (F.col(label_col) == 1)).select(F.col(id_col).alias("id"))
    measured = F.pmod(F.xxhash64(F.lit("quality"), F.col("id").cast("string")), F.lit(MEASURED)) == 0
    with shuffles_removed(spark):
        labelled, _ = split_by_keys(own, known, F.xxhash64("id"), F.xxhash64("id"))
        trusted, trusted_at = written_at(labelled.join(known.hint("merge"), "id").select("lang", "text", measured.alias("measured")), "trusted")
        vocabulary, others = vocabulary_of(trusted, size)
        trim = trimming(trusted, vocabulary)
        table = spark.sparkContext.broadcast(kneser_ney(trusted, vocabulary, others, trim))
        model = WordModel(trusted.where("NOT measured"), trusted_at, vocabulary, trim)
        scored = perplexities(own, model, vocabulary, table).withColumn("id", F.col("id").cast(kind))
        model.remove()
        trusted_rows = scored.join(known.distinct(), "id", "left_semi")
        uncounted = trusted_rows.where(measured)
        measured = uncounted if uncounted.head(1) else trusted_rows
        limit = (slack * F.percentile_approx("perplexity", quantile, 10_000)).alias("limit")
        limits = written(measured.groupBy("lang").agg(limit), "limits")
        general = measured.agg(limit).first()["limit"]
    threshold = F.coalesce("limit", F.lit(general).cast("double")) * F.exp(SHORT / F.sqrt(F.greatest("n", F.lit(1))))
    return (
        scored.join(limits.select(F.col("lang").alias("of"), "limit"), F.col("lang").eqNullSafe(F.col("of")), "left")
        .select(F.col("id").alias(id_col), "perplexity", threshold.alias("threshold"),
                F.coalesce(F.when(threshold.isNull(), F.col("perplexity").isNotNull()).otherwise(F.col("perplexity") <= threshold),
                           F.lit(False)).alias("kept"))
    )
