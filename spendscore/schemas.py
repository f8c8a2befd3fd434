"""Declared schema of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


INGESTION_DATE = "ingestion_date"

SALARY_INCOME = _table(
    customer_id=T.IntegerType(),
    salary_amount=T.DoubleType(),
    pay_date=T.DateType(),
    ingestion_date=T.DateType(),
)

TRANSACTIONS = _table(
    customer_id=T.IntegerType(),
    txn_date=T.DateType(),
    amount=T.DoubleType(),
    txn_type=T.StringType(),
    merchant=T.StringType(),
    channel=T.StringType(),
    mcc_code=T.IntegerType(),
    ingestion_date=T.DateType(),
)

DEBIT_TRANSACTIONS = T.StructType([*TRANSACTIONS, T.StructField("category", T.StringType())])

SUBSCRIPTIONS = _table(
    customer_id=T.LongType(),
    service_name=T.StringType(),
    amount=T.DoubleType(),
    frequency=T.StringType(),
    ingestion_date=T.DateType(),
)

CREDIT_CARD_STATEMENTS = _table(
    customer_id=T.IntegerType(),
    statement_date=T.DateType(),
    total_due=T.DoubleType(),
    minimum_due=T.DoubleType(),
    paid_amount=T.IntegerType(),
    ingestion_date=T.DateType(),
)

DEBIT_SILVER = T.StructType(
    [
        *DEBIT_TRANSACTIONS,
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

SCORE = _table(
    customer_id=T.IntegerType(),
    total_spend=T.DoubleType(),
    discretionary_ratio=T.DoubleType(),
    fixed_commitment_ratio=T.DoubleType(),
    salary_to_spend_ratio=T.DoubleType(),
    volatility_index=T.DoubleType(),
    recurring_spend_ratio=T.DoubleType(),
    sds_score=T.IntegerType(),
    score_month=T.StringType(),
)

SCORE_AUDIT = T.StructType(
    [
        *SCORE,
        T.StructField("calculation_id", T.StringType()),
        T.StructField("calculation_time", T.StringType()),
        T.StructField("calculated_by", T.StringType()),
    ]
)


# Streamed debits; a batch is a partition, which its repetition replaces.
DEBIT_STREAM = T.StructType([*DEBIT_TRANSACTIONS, T.StructField("batch", T.LongType())])

# Declared schema per stored table, so that reading one lists no file footers.
STORED: dict[str, T.StructType] = {
    "salary_income": SALARY_INCOME,
    "transactions": TRANSACTIONS,
    "debit_transactions": DEBIT_TRANSACTIONS,
    "subscriptions": SUBSCRIPTIONS,
    "credit_card_statements": CREDIT_CARD_STATEMENTS,
    "debit_transactions_silver": DEBIT_SILVER,
    "score": SCORE,
    "score_audit": SCORE_AUDIT,
    "debit_transactions_stream": DEBIT_STREAM,
}


def as_text(table: T.StructType) -> T.StructType:
    """The delivered columns of ``table`` as text, for lenient casts later."""
    return T.StructType([T.StructField(column.name, T.StringType()) for column in raw(table)])


def raw(table: T.StructType) -> T.StructType:
    """The columns a source delivers: the table without its load stamp."""
    return T.StructType([column for column in table if column.name != INGESTION_DATE])
