"""Vectors as whole numbers: what two operators do to their rows first."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def whole_numbers(df: DataFrame, vector_col: str, factor: int, name: str, most: int, offset: int = 0) -> tuple[DataFrame, int, int]:
    """``df`` with ``floor(factor * component) + offset`` as an array of longs, the dimension, and the largest absolute number.

    Only rows whose vector is usable stay; of these, such as have the most frequent length (of equally
    frequent ones the longest) and no number, before the offset, beyond ``most``. The dimension is 0 if no row stays.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    scaled = F.transform(vector, lambda c: F.floor(c * F.lit(float(factor))))
    inside = F.forall(vector, lambda c: F.abs(c * F.lit(float(factor))) <= F.lit(float(most)))
    rows = df.where(usable(vector)).where(F.size(vector) > 0).where(inside)
    least = rows.groupBy(F.size(vector).alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform(scaled, F.abs))).alias("top"))
    found = least.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    dim, top = (found[0]["d"], found[0]["top"]) if found else (0, 0)
    return rows.where(F.size(vector) == dim).withColumn(name, F.transform(scaled, lambda c: c + F.lit(offset))), dim, top
