"""Casts that turn bad input into NULL instead of failing the job.

The results are those of a session with ANSI mode off, without touching the
session: ANSI stays on and every expression says itself what it accepts.
One difference is deliberate: a bigint or decimal beyond the int range becomes
NULL rather than wrapping round to some other customer's id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL_RANGE = {
    T.IntegerType(): (-(2**31), 2**31 - 1),
    T.LongType(): (-(2**63), 2**63 - 1),
}

# Text that is a whole number once its fraction is cut off, and text that has
# a fraction only, which is 0. White space and control characters around it do
# not count.
_EDGE = r"[\s\x00-\x1f\x7f]*+"
_WHOLE_PART = rf"^{_EDGE}([+-]?\d++)(?:\.\d*+)?{_EDGE}$"
_FRACTION_ONLY = rf"^{_EDGE}[+-]?\.\d*+{_EDGE}$"
# Every spelling of a double has a digit or is one of these words.
_MAY_BE_DOUBLE = r"\d|(?i:nan|inf)"


def lenient_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast ``column`` of type ``source`` to ``target``; malformed is NULL.

    A failing ``try_cast`` costs an exception per row, so text that cannot be a
    number is kept away from it.
    """
    if source == target:
        return column
    if target in _INTEGRAL_RANGE:
        if isinstance(source, T.StringType):
            return _text_to_integral(column, target)
        if isinstance(source, (T.DoubleType, T.FloatType)):
            return _float_to_integral(column, target)
    if isinstance(source, T.StringType) and isinstance(target, T.DoubleType):
        return F.when(column.rlike(_MAY_BE_DOUBLE), column.try_cast(target))
    return column.try_cast(target)


def _text_to_integral(column: Column, target: T.DataType) -> Column:
    whole = F.nullif(F.regexp_extract(column, _WHOLE_PART, 1), F.lit(""))
    return F.coalesce(
        whole.try_cast(target), F.when(column.rlike(_FRACTION_ONLY), F.lit(0).cast(target))
    )


def _float_to_integral(column: Column, target: T.DataType) -> Column:
    low, high = _INTEGRAL_RANGE[target]
    return (
        F.when(F.isnan(column), F.lit(0).cast(target))
        .when(column >= F.lit(high), F.lit(high).cast(target))
        .when(column <= F.lit(low), F.lit(low).cast(target))
        .otherwise(column.try_cast(target))
    )
