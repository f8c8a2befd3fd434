"""Small expression builders; all stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(column: Column, substrings: Sequence[str]) -> Column:
    return reduce(Column.__or__, (column.contains(text) for text in substrings))


def month_label(column: Column) -> Column:
    """``2024_Jan``; an unknown date gives the empty string."""
    return F.coalesce(F.date_format(column, "yyyy_MMM"), F.lit(""))


def month_index(column: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(column) * 12 + F.month(column)


def run_date(as_of) -> Column:
    """The run's date: a given one, else the session's current date."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def null_skipping_sum(parts: Sequence[Column]) -> Column:
    """Row-wise sum that skips NULLs and is NULL only where all parts are."""
    zero = F.lit(0.0)
    total = reduce(Column.__add__, (F.coalesce(part, zero) for part in parts))
    return F.when(F.coalesce(*parts).isNotNull(), total)


def pearson(left: str, right: str) -> Column:
    """Correlation over the rows where both columns are known.

    NULL for a constant column, where ``corr`` would divide by zero.
    """
    x = F.when(F.col(right).isNotNull(), F.col(left))
    y = F.when(F.col(left).isNotNull(), F.col(right))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
