"""Near-duplicate vectors by spherical-cap filters.

Every unit vector is turned by a seeded rotation and cut into blocks. A filter
direction is the concatenation of one codeword per block, so a few codewords
stand for very many directions. List decoding finds all directions whose inner
product with the vector exceeds the cap height, pruning partial sums that no
remaining block can lift over it. Vectors sharing a direction meet in a bucket
and are verified by their exact cosine.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import removed, shipped, written_at
from spendscore.llm.components import connected

#: Rows of a bucket that meet at once; larger buckets are cut into such chunks and
#: every pair of chunks is a group of its own.
CHUNK = 400


@dataclass(frozen=True)
class CapFilters:
    """Directions and cap height for vectors of ``dim`` components."""

    dim: int
    blocks: int
    words: int
    height: float
    sets: int = 1
    seed: int = 7

    @classmethod
    def fitted(cls, dim: int, rows: int, cosine: float, hits: float = 20.0, sets: int = 4, bucket: int = 120, seed: int = 7):
        """Filters for ``rows`` vectors, in ``sets`` of independent rotations and codewords.

        Directions of one set hang together, so a few sets miss far fewer pairs than one of the
        same number of directions.

        The cap is as high as leaves about ``bucket`` evenly spread vectors in each,
        and there are as many directions as let a pair at exactly ``cosine``
        share ``hits`` of them on average. Both follow ``rows`` by one rule, the areas of caps on the
        sphere: a direction that is turned at random is spread evenly over it, product code or not.
        More than two blocks would make the directions of one set hang together too much.
        """
        share = min(0.02, max(1e-8, bucket / max(rows, 1)))
        height = float(np.cos(np.interp(share, *_cap_shares(dim)[::-1])))
        if dim < 24:
            height = min(height, 0.75)
        count = hits / sets / max(_sharing(dim, height, cosine), 1e-30)
        blocks = 1 if dim < 8 else 2
        return cls(dim, blocks, int(np.ceil(count ** (1 / blocks))), height, sets, seed)


def _cap_shares(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Angles, and the share of the sphere in ``dim`` dimensions within each of a fixed direction."""
    if dim < 2:  # two points
        return np.array([0.0, np.pi]), np.array([0.5, 1.0])
    angle = np.linspace(0, np.pi, 200_001)
    density = np.sin(angle) ** (dim - 2)
    sums = np.concatenate([[0], np.cumsum(density[1:] + density[:-1])])
    return angle, sums / sums[-1]


def _sharing(dim: int, height: float, cosine: float) -> float:
    """The probability that both vectors of a pair at ``cosine`` lie in the cap of an evenly drawn direction."""
    angle, within = _cap_shares(dim)
    top = float(np.arccos(height))
    if dim < 2:
        return 0.5 if cosine > 0 else 0.0
    grid = np.linspace(0, top, 4001)
    middle = (grid[1:] + grid[:-1]) / 2
    mass = np.diff(np.interp(grid, angle, within))
    rest = max(1e-9, 1 - cosine * cosine) ** 0.5
    least = np.clip((height - cosine * np.cos(middle)) / (rest * np.sin(middle)), -1, 1)
    around, share = _cap_shares(dim - 1)
    beside = np.interp(np.arccos(least), around, share) if dim > 2 else (1 + (least <= -1) - (least >= 1)) / 2
    return float((mass * beside).sum())


@functools.lru_cache(maxsize=64)
def _directions(filters: CapFilters, turn: int = 0) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and the codewords of every block of one set."""
    random = np.random.default_rng([filters.seed, turn])
    rotation = np.linalg.qr(random.standard_normal((filters.dim, filters.dim)))[0]
    words = []
    for part in np.array_split(np.arange(filters.dim), filters.blocks):
        w = random.standard_normal((filters.words, len(part)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / filters.blocks**0.5)
    return rotation, words


def decode(filters: CapFilters, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) for every direction whose cap holds the row."""
    found = [_decode(filters, unit, turn) for turn in range(filters.sets)]
    size = filters.words**filters.blocks
    return (np.concatenate([row for row, _ in found]), np.concatenate([code + turn * size for turn, (_, code) in enumerate(found)]))


def _decode(filters: CapFilters, unit: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    rotation, words = _directions(filters, turn)
    turned = unit @ rotation
    parts = np.array_split(np.arange(filters.dim), filters.blocks)
    scores = [turned[:, part] @ w.T for part, w in zip(parts, words)]
    row = np.arange(len(unit))
    code, total = np.zeros(len(unit), np.int64), np.zeros(len(unit))
    best = [s.max(axis=1) for s in scores]
    for k, score in enumerate(scores[:-1]):
        still = sum(best[k + 1 :], np.zeros(len(unit)))
        sums = total[:, None] + score[row]
        at, word = np.nonzero(sums + still[row][:, None] >= filters.height)
        code, total, row = code[at] * filters.words + word, sums[at, word], row[at]
    # The last block's words in order of score: those that lift a sum over the height are the first ones.
    order = np.argsort(-scores[-1], axis=1)
    ranked = np.take_along_axis(scores[-1], order, axis=1)
    low, high = np.zeros(len(row), np.int64), np.full(len(row), filters.words, np.int64)
    while (low < high).any():
        half = (low + high) // 2
        enough = (low < high) & (total + ranked[row, np.minimum(half, filters.words - 1)] >= filters.height)
        low, high = np.where(enough, half + 1, low), np.where(enough, high, np.where(low < high, half, high))
    at = np.repeat(np.arange(len(row)), low)
    place = np.arange(len(at)) - np.repeat(np.cumsum(low) - low, low)
    row, code = row[at], code[at] * filters.words + order[row[at], place]
    return row, code


def unit_vector(value) -> np.ndarray | None:
    """The direction in double precision; None where there is none."""
    if value is None or len(value) == 0 or any(x is None for x in value):
        return None
    v = np.asarray(value, np.float64)
    if not np.isfinite(v).all() or not (top := np.abs(v).max()):
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def _classes(batches):
    """Per row: a key equal for equal vectors, and the unit vector."""
    for pdf in batches:
        units = [unit_vector(v) for v in pdf["vector"]]
        pdf["dim"] = [0 if u is None else len(u) for u in units]
        # Adding zero turns -0.0 into 0.0.
        pdf["cls"] = [None if u is None else xxhash.xxh128_hexdigest((u + 0.0).tobytes()) for u in units]
        pdf["unit"] = [None if u is None else (u + 0.0).tobytes() for u in units]
        yield pdf[["id", "cls", "dim", "unit"]]


def _decoded(batches, chosen: dict[int, CapFilters]):
    """One row per vector with all its directions."""
    for pdf in batches:
        for dim, group in pdf.groupby("dim"):
            lists = [[] for _ in range(len(group))]
            units = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
            step = max(50, min(2000, 1_000_000 // chosen[dim].words))
            for start in range(0, len(units), step):
                for r, c in zip(*decode(chosen[dim], units[start : start + step])):
                    lists[start + r].append(int(c))
            yield group.assign(codes=[np.asarray(c, np.int64) for c in lists])


def _verified(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one pair of chunks of a bucket: what each row adds, and a row it links to.

    A pair that shares several directions is counted in the smallest alone.
    Chains of links leave as one link per row, to the first row of its local group.
    """
    n = len(pdf)
    units = np.frombuffer(b"".join(pdf["unit"]), np.float64).reshape(n, -1)
    side, weight, here = pdf["side"].to_numpy(), pdf["weight"].to_numpy(), pdf["code"].iloc[0]
    lower = [c[c < here] for c in pdf["codes"]]
    known, column = np.unique(np.concatenate(lower), return_inverse=True)
    shared = np.zeros((n, max(1, len(known))), np.float32)
    shared[np.repeat(np.arange(n), [len(x) for x in lower]), column] = 1
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    if pdf["i"].iloc[0] != pdf["j"].iloc[0]:  # pairs within a chunk belong to another group
        near &= side[:, None] != side[None, :]
    first = near & ~(shared @ shared.T > 0)
    group = np.arange(n)
    while True:
        after = np.minimum(group, np.where(near, group[None, :], n).min(axis=1))
        if (after == group).all():
            break
        group = after
    cls = pdf["cls"].to_numpy()
    out = pd.DataFrame({"a": cls, "links": first @ weight, "b": cls[group]})
    return out[(out["links"] > 0) | (out["a"] != out["b"])]


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    hits: float = 20.0,
    chunk: int = CHUNK,
    seed: int = 7,
) -> DataFrame:
    """Per row: ``id_col``, ``n_links``, ``component_id`` (smallest id reachable), ``kept``.

    Two rows link if their cosine in double precision is at least ``cosine``.
    Equal vectors are one class with a weight, so copies are never paired
    off. Pairs are found with the probability that ``hits`` stands for; below the
    cosine none is linked. Vectors of different length never link.

    * NULL, empty, zero or non-finite vectors and such with NULL components link with nothing.
    * Rows with equal vectors link with each other, equal ids or not; a NULL id
      takes part but is never a component's name unless all its ids are NULL.
    * An empty table gives no rows; further columns are ignored.
    """
    spark = shipped(vectors.sparkSession)
    rows, _ = written_at(
        vectors.select(F.col(id_col).cast("long").cast("string").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .mapInPandas(_classes, "id string, cls string, dim int, unit binary")
        .withColumn("id", F.col("id").cast("long")),
        "vectors",
    )
    classes, classes_at = written_at(
        rows.where("cls IS NOT NULL").groupBy("cls")
        .agg(F.count(F.lit(1)).alias("weight"), F.first("dim").alias("dim"), F.first("unit").alias("unit")),
        "classes",
    )
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = {dim: CapFilters.fitted(dim, n, cosine, hits, seed=seed) for dim, n in sizes.items()}
    decoded, decoded_at = written_at(
        classes.repartition(max(1, sum(sizes.values()) // 4000), "cls").mapInPandas(
            functools.partial(_decoded, chosen=chosen),
            "cls string, weight long, dim int, unit binary, codes array<long>",
        ),
        "decoded",
    )
    buckets, buckets_at = written_at(
        decoded.select("dim", F.explode("codes").alias("code")).groupBy("dim", "code")
        .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")),
        "buckets",
    )
    member = (
        decoded.withColumn("code", F.explode("codes")).join(buckets.drop("n"), ["dim", "code"])
        .withColumn("own", F.pmod(F.xxhash64("cls"), "chunks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("dim", "code", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "cls", "weight", "unit", "codes")
    )
    found, found_at = written_at(
        member.groupBy("dim", "code", "i", "j").applyInPandas(
            lambda pdf: _verified(pdf, cosine), "a string, links long, b string"
        ),
        "links",
    )
    roots = connected(found)
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    per_class, _ = written_at(
        classes.select("cls", "weight")
        .join(links.withColumnRenamed("a", "cls"), "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", F.coalesce("root", "cls").alias("root"),
                (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "vector-classes",
    )
    removed(spark, classes_at, decoded_at, buckets_at, found_at)
    ids = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("id").alias("least"))
    names, _ = written_at(
        per_class.join(ids, "cls").groupBy("root").agg(F.min("least").alias("component_id")), "names"
    )
    named, _ = written_at(per_class.join(names, "root").select("cls", "n_links", "component_id"), "named")
    return rows.join(named, "cls", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )
