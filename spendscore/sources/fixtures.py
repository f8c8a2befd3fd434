"""The four inputs, mapped from the test tables as FIXTURES.md describes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Merchant names by part key modulo their number; the last is NULL.
MERCHANTS: tuple[str | None, ...] = (
    "Zillow", "RentPay", "Landlord LLC", "BC Hydro", "Enbridge Gas", "TELUS Mobility",
    "Netflix", "Spotify", "Amazon Prime Video", "Zomato", "Costco", "Uber Eats", "UBER Trip",
    "Swiggy", "Visa Payment", "AMEX", "EMI Portal", "Amazon Marketplace", "Shopping Mall",
    "Flipkart", "BigBazaar", "Myntra", "Flights R Us", "Premier Gym", "Corner Store", "Enbrdge",
    None,
)

# Pay dates with what is added to the salary on each.
PAY_DATES: tuple[tuple[int, date], ...] = (
    (0, date(2024, 1, 31)),
    (500, date(2024, 2, 29)),
    (1000, date(2024, 3, 31)),
)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _pick(column, choices) -> Column:
    """``choices[column]`` for a column that holds a position."""
    return F.get(F.lit(list(choices)), column.cast("int"))


def _whole_cents(value) -> Column:
    return (F.floor(value) / 100).cast("double")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = _read(spark, sf_dir, "lineitem"), _read(spark, sf_dir, "orders")
    merchants = F.array(*[F.lit(name) for name in MERCHANTS])
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        _whole_cents(F.col("l_extendedprice") * 25).alias("amount"),
        F.when(F.col("l_returnflag") == "R", "Credit")
        .when(F.col("l_returnflag") == "A", "DEBIT")
        .otherwise("Debit")
        .alias("txn_type"),
        F.get(merchants, (F.col("l_partkey") % len(MERCHANTS)).cast("int")).alias("merchant"),
        _pick(F.col("l_linenumber") % 3, ("POS", "Online", "Mobile")).alias("channel"),
        (5000 + F.col("l_suppkey") % 100).cast("int").alias("mcc_code"),
    )


def salary_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    pays = F.array(
        *[F.struct(F.lit(float(bump)).alias("bump"), F.lit(day).alias("pay_date"))
          for bump, day in PAY_DATES]
    )
    # every tenth salary is unknown
    balance = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"), balance.alias("balance"), F.inline(pays)
    ).select("customer_id", (F.col("balance") * 16.0 + F.col("bump")).alias("salary_amount"), "pay_date")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    services = ("Netflix", "Spotify", "Amazon Prime", "Gym")
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        _pick(F.col("c_custkey") % 4, services).alias("service_name"),
        ((F.lit(999) + F.col("c_nationkey") * 100).cast("double") / 100).alias("amount"),
        F.when(F.col("c_nationkey") % 2 == 0, "monthly").otherwise("yearly").alias("frequency"),
    )


def credit_card_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.col("o_totalprice")
    return _read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("statement_date"),
        total.alias("total_due"),
        _whole_cents(total * 5).alias("minimum_due"),
        _whole_cents(total * (F.col("o_orderkey") % 101)).alias("paid_amount"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table in the shape of the daily spend stream."""
    return event_columns(_read(spark, sf_dir, "events"))


def event_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("user_id").cast("int").alias("customer_id"),
        "ts",
        F.col("value").alias("amount"),
        F.col("event_type").alias("txn_type"),
    )
