from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore.functions.casts import lenient_cast
from spendscore.functions.expressions import month_label, null_skipping_sum


def cast_all(spark, values, source, target):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", source)]))
    return [row[0] for row in df.select(lenient_cast(F.col("v"), source, target)).collect()]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("10", 10), (" 10 ", 10), ("+7", 7), ("-7", -7), ("10.75", 10), ("-10.75", -10),
        (".5", 0), ("10.", 10), ("10.99999999999", 10), ("\t3.5\n", 3), (".", 0),
        ("", None), ("+", None), ("1e3", None), ("abc", None), ("1 2", None), ("1.2.3", None),
        ("2147483647", 2147483647), ("2147483648", None), ("-2147483648.9", -2147483648), (None, None),
    ],
)
def test_text_to_int(spark, text, number):
    assert cast_all(spark, [text], T.StringType(), T.IntegerType()) == [number]


def test_double_to_int_saturates_and_truncates(spark):
    values = [10.75, -10.75, 3e10, -3e10, float("nan"), float("inf"), None]
    assert cast_all(spark, values, T.DoubleType(), T.IntegerType()) == [
        10, -10, 2**31 - 1, -(2**31), 0, 2**31 - 1, None,
    ]
    assert cast_all(spark, [1e30, -1e30], T.DoubleType(), T.LongType()) == [2**63 - 1, -(2**63)]


def test_bigint_beyond_int_is_null_and_not_another_id(spark):
    assert cast_all(spark, [3_000_000_000, 5], T.LongType(), T.IntegerType()) == [None, 5]


def test_text_to_double_and_date(spark):
    texts = ["NaN", "1.5", "x", "", "n/a", "1d", " 2 ", "1e3", "-Infinity", "inf", "info", ".5", None]
    doubles = cast_all(spark, texts, T.StringType(), T.DoubleType())
    assert math.isnan(doubles[0])
    assert doubles[1:] == [
        1.5, None, None, None, 1.0, 2.0, 1000.0, -math.inf, math.inf, None, 0.5, None,
    ]
    # the check beforehand takes nothing away that the cast alone accepts
    df = spark.createDataFrame([(text,) for text in texts], "v string")
    alone = [row[0] for row in df.select(F.col("v").try_cast("double")).collect()]
    assert alone[1:] == doubles[1:]
    texts = ["2024-01-05", "2024-1-5", "2024", "2024-02-30", "31/01/2024", None]
    assert cast_all(spark, texts, T.StringType(), T.DateType()) == [
        date(2024, 1, 5), date(2024, 1, 5), date(2024, 1, 1), None, None, None,
    ]


def test_month_label(spark):
    df = spark.createDataFrame([(date(2024, 1, 31),), (None,)], "d date")
    assert [row[0] for row in df.select(month_label(F.col("d"))).collect()] == ["2024_Jan", ""]


def test_null_skipping_sum(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.0)], "a double, b double")
    total = null_skipping_sum([F.col("a"), F.col("b")])
    assert [row[0] for row in df.select(total).collect()] == [1.0, None, 3.0]
