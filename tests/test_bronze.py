from __future__ import annotations

from datetime import date

import pytest

from spendscore import schemas
from spendscore.config import CATEGORY_RULES
from spendscore.operators import bronze

DAY = date(2024, 4, 1)


@pytest.mark.parametrize(
    ("merchant", "label"),
    [
        ("zillow rent", "Rent"), ("my landlord", "Rent"), ("bc hydro", "Utilities"),
        ("amazon prime video", "Subscriptions"),  # before plain amazon
        ("amazon marketplace", "Misc. Discretionary"),
        ("uber trip", "Food & Groceries"),  # the later rule on uber is never reached
        ("premier gym", "Credit Repayment"),  # "emi" inside a word
        ("enbrdge", "Other"), ("Netflix", "Other"),  # not lower case
        ("", "Other"), (None, "Other"),
        ("rentpay visa", "Rent"),  # first rule wins
    ],
)
def test_category(spark, merchant, label):
    df = spark.createDataFrame([(merchant,)], "merchant string")
    assert bronze.categorize(df).first()["category"] == label


def test_every_substring_reaches_a_label(spark):
    for index, (label, substrings) in enumerate(CATEGORY_RULES):
        df = spark.createDataFrame([(f"x{text}y",) for text in substrings], "merchant string")
        earlier = {name for name, _ in CATEGORY_RULES[: index + 1]}
        assert {row["category"] for row in bronze.categorize(df).collect()} <= earlier


def test_rules_are_data(spark):
    df = spark.createDataFrame([("a b",), ("c",)], "merchant string")
    rows = bronze.categorize(df, [("First", ["a"]), ("Second", ["b", "c"])]).collect()
    assert [row["category"] for row in rows] == ["First", "Second"]
    assert bronze.categorize(df, [], other="?").first()["category"] == "?"


def test_conform_transactions_from_text(spark):
    raw = spark.createDataFrame(
        [("7", "2024-01-05", "12.5", "DEBIT", "Uber EATS", "POS", "5812"),
         ("x", "05/01/2024", "?", None, None, None, "58.9")],
        "customer_id string, txn_date string, amount string, txn_type string, merchant string, "
        "channel string, mcc_code string",
    )
    df = bronze.conform_transactions(raw, DAY)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schemas.TRANSACTIONS
    ]
    assert [tuple(row) for row in df.collect()] == [
        (7, date(2024, 1, 5), 12.5, "debit", "uber eats", "pos", 5812, DAY),
        (None, None, None, None, None, None, 58, DAY),
    ]


def test_conform_keeps_declared_types(spark):
    statements = spark.createDataFrame(
        [(1, "2024-01-05", 100.0, 5.0, 10.75)],
        "customer_id long, statement_date string, total_due double, minimum_due double, "
        "paid_amount double",
    )
    row = bronze.conform_statements(statements, DAY).first()
    assert row["paid_amount"] == 10
    subscription = spark.createDataFrame(
        [(3_000_000_000, "Gym", 9.99, "monthly")],
        "customer_id long, service_name string, amount double, frequency string",
    )
    assert bronze.conform_subscriptions(subscription, DAY).first()["customer_id"] == 3_000_000_000


def test_without_a_date_the_stamp_is_today(spark):
    raw = spark.createDataFrame(
        [(1, 10.0, "2024-01-31")], "customer_id int, salary_amount double, pay_date string"
    )
    today = spark.sql("SELECT current_date()").first()[0]
    assert bronze.conform_salary(raw).first()["ingestion_date"] == today


def test_debit_only_drops_unknown_types(spark):
    df = spark.createDataFrame([("Debit",), ("credit",), (None,), ("DEBIT",)], "txn_type string")
    assert bronze.debit_only(df).count() == 2
