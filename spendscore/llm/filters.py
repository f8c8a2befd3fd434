"""Filters of a fixed size over hashes: what isn't in them needn't be shuffled.

A filter lets through all it was made from and, the fuller it is, some other hashes
too; exact joins follow. Its size is a parameter and doesn't grow with the data, so it can be
broadcast. It is united slice by slice in tasks, and the driver gets one filter.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import shipped, tidied, unused, written

SLICES = 32


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash (uint64) in a filter of 2^bits places."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)


def _set(on: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (on[at >> 3] >> (at & 7).astype(np.uint8)) & 1


def passing(on: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where hashes are in the filter."""
    bits = int(len(on) * 8).bit_length() - 1
    first, _ = places(hashes, bits)
    at = np.flatnonzero(_set(on, first))
    return at[_set(on, places(hashes[at], bits)[1]).astype(bool)]


@tidied
def _member_part(batches, bits: int):
    on = np.zeros(1 << (bits - 3), np.uint8)
    for pdf in batches:
        for at in places(pdf["hash"].to_numpy().view(np.uint64), bits):
            np.bitwise_or.at(on, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    parts = np.array_split(on, SLICES)
    yield pd.DataFrame({"slice": range(SLICES), "bits": [zlib.compress(x.tobytes(), 1) for x in parts]})


@tidied
def _united(batches):
    whole: dict[int, np.ndarray] = {}
    for pdf in batches:
        for k, data in zip(pdf["slice"], pdf["bits"]):
            part = np.frombuffer(zlib.decompress(data), np.uint8)
            whole[k] = whole[k] | part if k in whole else part
    for k, part in whole.items():
        yield pd.DataFrame({"slice": [k], "bits": [part.tobytes()]})


def member_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """A filter that all values of the column ``hash`` pass."""
    shipped(hashes.sparkSession)
    parts = hashes.select("hash").mapInPandas(functools.partial(_member_part, bits=bits), "slice int, bits binary")
    rows = parts.repartition(SLICES, "slice").mapInPandas(_united, "slice int, bits binary").collect()
    if not rows:
        return np.zeros(1 << (bits - 3), np.uint8)
    return np.concatenate([np.frombuffer(r["bits"], np.uint8) for r in sorted(rows, key=lambda r: r["slice"])])


#: Words of 64 places of a filter that is a table: at most 65,536 rows, 1 MB, to broadcast.
TABLE_WORDS = 1 << 16


def split_by_keys(df: DataFrame, keys: DataFrame, own: Column, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose hash ``own`` may be among the hashes ``key`` of ``keys``, and the rows for which it can't.

    Only the first need to meet ``keys`` in a join, so wide rows without a key aren't
    shuffled. Built-in expressions alone.
    """
    word = lambda h: F.pmod(F.shiftrightunsigned(h, 6), F.lit(TABLE_WORDS))
    place = lambda h: h.bitwiseAND(F.lit(63)).cast("int")
    hashes = keys.select(key.alias("h"))
    of_word, of_bits = unused(df, "__word", "__bits")
    bit = F.expr("shiftleft(1L, cast(h & 63 AS int))")
    table = written(
        hashes.select(word(F.col("h")).alias(of_word), bit.alias("bit")).groupBy(of_word).agg(F.bit_or("bit").alias(of_bits)),
        "key-filter",
    )
    marked = df.join(F.broadcast(table), word(own) == F.col(of_word), "left")
    may = F.coalesce(F.getbit(of_bits, place(own)) == 1, F.lit(False))
    return marked.where(may).drop(of_word, of_bits), marked.where(~may).drop(of_word, of_bits)
