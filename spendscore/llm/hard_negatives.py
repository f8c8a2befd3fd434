"""Hard negatives by Four-Russians scoring.

An inner product of whole numbers is taken apart into bits of the candidate: its components, in two's complement,
are stored as bit planes, eight components to a byte. For each anchor and each group of eight
components there is a table of all 256 subset sums of the anchor's eight numbers. A
score is then one lookup a byte, summed over the groups, shifted by the plane and added up:
exact, with no multiplication.

Anchors are a query set: they are taken in slabs of a stated size, each sent to all tasks, which
read the packed candidates where they lie. Nothing of the candidates is shuffled but the
best few of each task. Two passes a slab: the anchors' positives first, then the
negatives in the range of scores that each positive leaves.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscore.llm.common import removed, shipped, written_at
from spendscore.llm.vectors import whole_numbers

#: Components in a byte, and the subsets of as many.
GROUP = 8
SUBSETS = 1 << GROUP
#: Anchors sent to the tasks at once (64 components: 2 MB, and 16 MB of tables in a task).
SLAB = 4096
#: Anchors scored at once: their tables and partial sums stay in the processor's cache.
ANCHORS = 512
#: Candidates scored at once.
ROWS = 1024
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: What scores are cut to in a task: a list's number, the candidate and its score.
FOUND = "list int, id long, score long"


def planes_of(numbers: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of whole numbers (rows x components), as rows x planes x groups of eight."""
    dim = numbers.shape[1]
    padded = np.zeros((len(numbers), -(-dim // GROUP) * GROUP), np.int64)
    padded[:, :dim] = numbers
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def numbers_of(packed: np.ndarray, planes: int, dim: int) -> np.ndarray:
    """The numbers whose bit planes these are."""
    bits = np.unpackbits(packed.reshape(len(packed), planes, -1), axis=2, bitorder="little")[:, :, :dim].astype(np.int64)
    weight = np.int64(1) << np.arange(planes, dtype=np.int64)
    weight[-1] = -weight[-1]
    return (bits * weight[None, :, None]).sum(axis=1)


def subset_sums(anchors: np.ndarray, planes: int) -> np.ndarray:
    """Per group of eight components, the sums over all subsets for each anchor: groups x 256 x anchors."""
    dim = anchors.shape[1]
    groups = -(-dim // GROUP)
    reach = int(np.abs(anchors).max(initial=0)) * dim
    kind = next(t for t in (np.int16, np.int32, np.int64) if reach <= np.iinfo(t).max)
    padded = np.zeros((groups * GROUP, len(anchors)), kind)
    padded[:dim] = anchors.T
    sums = np.zeros((groups, SUBSETS, len(anchors)), kind)
    for g in range(groups):
        for bit in range(GROUP):
            sums[g, 1 << bit : 2 << bit] = sums[g, : 1 << bit] + padded[g * GROUP + bit]
    return sums


def scores(packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products of candidates (rows x planes x groups) with the anchors of ``sums``."""
    rows, planes, groups = packed.shape
    wide = np.int32 if sums.dtype == np.int16 and planes <= 15 else np.int64
    total = np.zeros((rows, sums.shape[2]), wide)
    plane_sum, looked_up = np.empty(total.shape, sums.dtype), np.empty(total.shape, sums.dtype)
    for p in range(planes):
        np.take(sums[0], packed[:, p, 0], axis=0, out=plane_sum, mode="clip")
        for g in range(1, groups):
            np.take(sums[g], packed[:, p, g], axis=0, out=looked_up, mode="clip")
            plane_sum += looked_up
        shifted = plane_sum.astype(wide) << p
        if p == planes - 1:
            total -= shifted
        else:
            total += shifted
    return total


def within(values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Bounds in the type of the scores; what lies beyond it, beyond all scores, is cut to its ends."""
    return np.clip(values, np.iinfo(kind).min, np.iinfo(kind).max).astype(kind)


class Best:
    """The first few of each of many lists: higher scores first, ties by smaller id, equal entries once."""

    def __init__(self, lists: int, keep: int):
        self.keep = keep
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.least = np.full(lists, np.iinfo(np.int64).min)
        self.least_id = np.full(lists, np.iinfo(np.int64).max)

    def add(self, number: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(number):
            return
        number, ids, score = (np.concatenate(x) for x in zip(self.found, (number, ids, score.astype(np.int64))))
        order = np.lexsort((ids, -score, number))
        number, ids, score = number[order], ids[order], score[order]
        again = np.zeros(len(number), bool)
        again[1:] = (number[1:] == number[:-1]) & (ids[1:] == ids[:-1]) & (score[1:] == score[:-1])
        number, ids, score = number[~again], ids[~again], score[~again]
        start = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        rank = np.arange(len(number)) - np.repeat(start, np.diff(np.r_[start, len(number)]))
        last = rank == self.keep - 1
        self.least[number[last]], self.least_id[number[last]] = score[last], ids[last]
        self.found = tuple(x[rank < self.keep] for x in (number, ids, score))

    def better(self, score: np.ndarray, ids: np.ndarray, lists: slice) -> np.ndarray:
        """Where entries (candidates x lists) come before the last that is kept."""
        least = within(self.least[lists], score.dtype)
        return (score > least) | ((score == least) & (ids[:, None] < self.least_id[lists]))

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("list", "id", "score"), (self.found[0].astype(np.int32), *self.found[1:]))))


def _packed(batches, planes: int):
    for pdf in batches:
        numbers = np.asarray([*pdf.pop("x")], np.int64)
        if len(pdf):
            pdf["planes"] = [row.tobytes() for row in planes_of(numbers, planes)]
            yield pdf[["id", "label", "planes"]]


def _pieces(batches, planes: int):
    """Ids, labels and bit planes of some hundred candidates at a time."""
    for pdf in batches:
        for start in range(0, len(pdf), ROWS):
            part = pdf.iloc[start : start + ROWS]
            packed = np.frombuffer(b"".join(part["planes"]), np.uint8).reshape(len(part), planes, -1)
            yield part["id"].to_numpy(), part["label"].to_numpy(), packed


def _positives(batches, slab, planes: int, keep: int):
    """The first rows of the anchors' own labels among one task's candidates; ``slab``'s anchors are in the order of labels."""
    anchor, label, numbers = slab.value
    best = Best(len(anchor), keep)
    bounds = {}
    for start in np.flatnonzero(np.r_[True, label[1:] != label[:-1]]):
        own = label[start]
        end = int(np.searchsorted(label, own, side="right"))
        bounds[own] = [(at, min(end, at + ANCHORS)) for at in range(int(start), end, ANCHORS)]
    sums: dict[tuple[int, int], np.ndarray] = {}
    for ids, labels, packed in _pieces(batches, planes):
        for own in np.unique(labels):
            here = np.flatnonzero(labels == own)
            for at, end in bounds.get(own, ()):
                if (at, end) not in sums:
                    sums[at, end] = subset_sums(numbers[at:end], planes)
                score = scores(packed[here], sums[at, end])
                want = best.better(score, ids[here], slice(at, end)) & (ids[here, None] != anchor[None, at:end])
                row, column = np.nonzero(want)
                best.add(at + column, ids[here][row], score[row, column])
    yield best.frame()


def _negatives(batches, slab, bands, planes: int, keep: int):
    """The first rows of other labels, in the range of each positive, among one task's candidates."""
    _, label, numbers = slab.value
    low, high = bands.value  # anchors x positives; an empty range where there is no positive
    each = low.shape[1]
    best = Best(low.size, keep)
    chunks = [(at, min(len(label), at + ANCHORS)) for at in range(0, len(label), ANCHORS)]
    sums: dict[int, np.ndarray] = {}
    for ids, labels, packed in _pieces(batches, planes):
        for at, end in chunks:
            if at not in sums:
                sums[at] = subset_sums(numbers[at:end], planes)
            score = scores(packed, sums[at])
            from_ = np.maximum(low[at:end], best.least.reshape(-1, each)[at:end])
            lowest = np.where(from_ <= high[at:end], from_, np.iinfo(np.int64).max).min(axis=1)
            want = (score >= within(lowest, score.dtype)) & (score <= within(high[at:end].max(axis=1), score.dtype))
            row, column = np.nonzero(want & (labels[:, None] != label[None, at:end]))
            value, own = score[row, column].astype(np.int64), ids[row]
            least = best.least.reshape(-1, each)[at + column]
            inside = (value[:, None] >= low[at + column]) & (value[:, None] <= high[at + column])
            inside &= (value[:, None] > least) | ((value[:, None] == least) & (own[:, None] < best.least_id.reshape(-1, each)[at + column]))
            hit, which = np.nonzero(inside)
            best.add((at + column[hit]) * each + which, own[hit], value[hit])
    yield best.frame()


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first rows of each list over all tasks, with their rank."""
    order = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= keep).distinct()


def _range(score: np.ndarray, lower: int, upper: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores s with lower * p <= 100 * s <= upper * p, in whole numbers of any size."""
    low = [-(-(lower * int(p)) // 100) for p in score.ravel()]
    high = [upper * int(p) // 100 for p in score.ravel()]
    return np.asarray(low, np.int64).reshape(score.shape), np.asarray(high, np.int64).reshape(score.shape)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    lower: int = 80,
    upper: int = 100,
    slab: int = SLAB,
) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels that score nearly as high.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``anchors`` is a condition
    on the rows. Components become ``floor(scale * component)``; a score is the inner product with the anchor,
    exact. Positives are an anchor's first ``positives`` rows of its label with another id, negatives rows
    of another label whose score is from ``lower`` to ``upper`` per cent of the positive's. Higher scores
    come first, ties by the smaller id. Every row is scored against every anchor; no candidate is left out beforehand.

    * NULL ids and labels, NULL or empty vectors and such with NULL or non-finite components take no part; nor do vectors of another
      than the most frequent length, or with a number so large that a score might not be a long.
    * Repeated rows count once: a list holds an id with one score once. Rows that share an id but not the vector are
      rows of their own, as anchors too.
    * Without anchors, positives or negatives in range there are no rows; extra columns, whatever their
      names, are not looked at.
    """
    spark = shipped(vectors.sparkSession)
    label = F.col(f"`{label_col}`").cast("long")
    known = vectors.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull())
    # A bound that holds for any dimension up to 2^15: 2^15 products of 2^24 * 2^24 are a long.
    rows, dim, top = whole_numbers(
        known.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), F.col(f"`{vector_col}`").alias("vector"),
                     F.coalesce(anchors, F.lit(False)).alias("anchor")),
        "vector", scale, "x", most=1 << 24)
    out_at = []
    if not dim:
        return spark.createDataFrame([], RESULT)
    planes = int(top).bit_length() + 1
    packed, packed_at = written_at(
        rows.select("id", "label", "x").mapInPandas(functools.partial(_packed, planes=planes), "id long, label long, planes binary"),
        "planes")
    asked, asked_at = written_at(rows.where("anchor").select("id", "label", "x").distinct(), "anchors")
    number = asked.count()
    # Slabs by hash, three quarters full, so that none gets much larger than the bound.
    slabs = max(1, math.ceil(number / max(1, slab * 3 // 4)))
    for k in range(slabs if number else 0):
        mine = asked.where(F.pmod(F.xxhash64("id", "label", "x"), F.lit(slabs)) == k).toPandas().sort_values(["label", "id"], kind="stable")
        if not len(mine):
            continue
        numbers = np.asarray([*mine["x"]], np.int64).reshape(len(mine), dim)
        sent = spark.sparkContext.broadcast((mine["id"].to_numpy(), mine["label"].to_numpy(), numbers))
        near = _first(packed.mapInPandas(functools.partial(_positives, slab=sent, planes=planes, keep=positives), FOUND), positives).toPandas()
        column, rank = near["list"].to_numpy(), near["rank"].to_numpy() - 1
        score, ids = np.zeros((len(mine), positives), np.int64), np.zeros((len(mine), positives), np.int64)
        score[column, rank], ids[column, rank] = near["score"], near["id"]
        low, high = _range(score, lower, upper)
        absent = np.ones(score.shape, bool)
        absent[column, rank] = False
        low[absent], high[absent] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        bands = spark.sparkContext.broadcast((low, high))
        found = _first(packed.mapInPandas(functools.partial(_negatives, slab=sent, bands=bands, planes=planes, keep=negatives), FOUND), negatives)
        named = spark.createDataFrame(
            pd.DataFrame({"list": np.arange(score.size, dtype=np.int32), "anchor_id": np.repeat(mine["id"].to_numpy(), positives),
                          "positive_id": ids.ravel(), "positive_score": score.ravel()})[~absent.ravel()],
            "list int, anchor_id long, positive_id long, positive_score long") if len(near) else None
        if named is not None:
            out, at = written_at(
                found.join(named, "list").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                                 "positive_score", F.col("score").alias("negative_score")), "negatives")
            out_at.append(at)
        sent.destroy()
        bands.destroy()
    removed(spark, packed_at, asked_at)
    return spark.read.schema(RESULT).parquet(*out_at) if out_at else spark.createDataFrame([], RESULT)
