"""Conform raw inputs to their declared schemas and label debits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore import schemas
from spendscore.config import CATEGORY_RULES, OTHER_CATEGORY
from spendscore.functions.casts import lenient_cast
from spendscore.functions.expressions import contains_any, run_date


def conform(
    df: DataFrame, table: T.StructType, as_of: date | None = None, *, lowered: Sequence[str] = ()
) -> DataFrame:
    """Project ``df`` onto ``table``: lenient casts, lower case, load stamp."""

    def column(spec: T.StructField):
        value = lenient_cast(F.col(spec.name), df.schema[spec.name].dataType, spec.dataType)
        return (F.lower(value) if spec.name in lowered else value).alias(spec.name)

    return df.select(
        *[column(spec) for spec in schemas.raw(table)],
        run_date(as_of).alias(schemas.INGESTION_DATE),
    )


def conform_salary(df: DataFrame, as_of: date | None = None) -> DataFrame:
    return conform(df, schemas.SALARY_INCOME, as_of)


def conform_transactions(df: DataFrame, as_of: date | None = None) -> DataFrame:
    return conform(
        df, schemas.TRANSACTIONS, as_of, lowered=("txn_type", "merchant", "channel")
    )


def conform_subscriptions(df: DataFrame, as_of: date | None = None) -> DataFrame:
    return conform(df, schemas.SUBSCRIPTIONS, as_of)


def conform_statements(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """``paid_amount`` is a whole number here: its cents are cut off."""
    return conform(df, schemas.CREDIT_CARD_STATEMENTS, as_of)


def debit_only(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.lower("txn_type") == "debit")


def categorize(
    df: DataFrame,
    rules: Sequence[tuple[str, Sequence[str]]] = CATEGORY_RULES,
    *,
    merchant: str = "merchant",
    other: str = OTHER_CATEGORY,
) -> DataFrame:
    """Add ``category``: the first rule one of whose substrings occurs.

    Substrings are matched as they are, so ``merchant`` should be lower case.
    """
    label = F.lit(other)
    for name, substrings in reversed(rules):
        label = F.when(contains_any(F.col(merchant), substrings), F.lit(name)).otherwise(label)
    return df.withColumn("category", label)


def debit_transactions(transactions: DataFrame, rules=CATEGORY_RULES) -> DataFrame:
    """Labelled debits out of conformed transactions."""
    return categorize(debit_only(transactions), rules)
