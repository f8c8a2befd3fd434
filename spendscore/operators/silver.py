"""Spend features of labelled debits: days, months, repeats, profiles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore.functions.casts import lenient_cast
from spendscore.functions.expressions import month_label


def with_year_month(debit: DataFrame) -> DataFrame:
    """The stored silver row: amount as a double, plus year and month."""
    return debit.withColumns(
        {
            "amount": lenient_cast(F.col("amount"), debit.schema["amount"].dataType, T.DoubleType()),
            "year": F.year("txn_date"),
            "month": F.month("txn_date"),
        }
    )


def daily_spend(debit: DataFrame) -> DataFrame:
    return debit.groupBy("customer_id", "txn_date").agg(F.sum("amount").alias("daily_spend"))


def volatility(debit: DataFrame, name: str = "spend_volatility") -> DataFrame:
    """Sample deviation of the daily spend; NULL for a single active day."""
    return daily_spend(debit).groupBy("customer_id").agg(F.stddev("daily_spend").alias(name))


def merchant_groups(debit: DataFrame) -> DataFrame:
    """Rows per (customer, category, merchant); NULL is a merchant of its own."""
    return debit.groupBy("customer_id", "category", "merchant").agg(
        F.count("txn_type").alias("transaction_count"), F.count(F.lit(1)).alias("group_rows")
    )


def recurring_merchants(debit: DataFrame, min_count: int = 2) -> DataFrame:
    """Groups seen at least ``min_count`` times, whatever the interval."""
    return (
        merchant_groups(debit)
        .filter(F.col("transaction_count") >= min_count)
        .drop("group_rows")
    )


def monthly_spend(debit: DataFrame) -> DataFrame:
    return (
        debit.groupBy(
            "customer_id",
            "merchant",
            "category",
            F.year("txn_date").alias("year"),
            F.month("txn_date").alias("month"),
        )
        .agg(F.sum("amount").alias("monthly_spend"))
        .withColumn("year_month", month_label(F.make_date("year", "month", F.lit(1))))
    )


def month_labels(first: date, last: date) -> list[str]:
    """The labels ``2024_Jan`` ... of all months from ``first`` to ``last``."""
    names = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{index // 12}_{names[index % 12]}" for index in months]


def pivot_months(
    monthly: DataFrame, months: Sequence[str] | None = None, agg: str = "first"
) -> DataFrame:
    """One row per customer and one column per month.

    ``agg="first"`` keeps one (merchant, category) figure of the month, the
    first by name; ``agg="sum"`` adds them all. Give ``months`` on large data:
    without them Spark runs an extra job that lists the months.
    """
    cell = ("customer_id", "year_month")
    if agg == "first":
        # names can't be aggregated by hash: the rows of a cell are brought together first and sorted once
        monthly = monthly.repartition(*cell)
        value = F.min_by("monthly_spend", F.struct("merchant", "category"))
    elif agg == "sum":
        value = F.sum("monthly_spend")
    else:
        raise ValueError(f"agg must be 'first' or 'sum', not {agg!r}")
    cells = monthly.groupBy(*cell).agg(value.alias("_value"))
    # a customer has a narrow row per month until they are in one place; wide rows are not shuffled
    return cells.repartition("customer_id").groupBy("customer_id").pivot("year_month", months).agg(F.max("_value"))


def spend_profile(debit: DataFrame) -> DataFrame:
    """Per customer: total, volatility, number of recurring merchant groups.

    An unknown customer matches nothing, so it keeps its total alone.
    """
    known = F.col("customer_id").isNotNull()
    spend = (
        daily_spend(debit)
        .groupBy("customer_id")
        .agg(
            F.sum("daily_spend").alias("total_spend"),
            F.stddev("daily_spend").alias("spend_volatility"),
        )
        .withColumn("spend_volatility", F.when(known, F.col("spend_volatility")))
    )
    recurring = (
        recurring_merchants(debit)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("recurring_merchants"))
    )
    return spend.join(recurring, "customer_id", "left").withColumn(
        "recurring_merchants", F.coalesce("recurring_merchants", F.lit(0).cast("long"))
    )


def profile_fanout_size(debit: DataFrame) -> DataFrame:
    """Row count of joining rows, rolling rows and repeats on the customer.

    That join pairs every row of a customer with every other one, so it is
    counted from per-customer figures instead of being run.
    """
    whole = "decimal(38,0)"
    per_customer = merchant_groups(debit).groupBy("customer_id").agg(
        F.sum("group_rows").cast(whole).alias("n"),
        F.sum(F.when(F.col("transaction_count") > 1, 1).otherwise(0)).cast(whole).alias("r"),
    )
    pairs = F.col("n") * F.col("n") * F.greatest(F.col("r"), F.lit(1))
    joined = F.when(F.col("customer_id").isNull(), F.col("n")).otherwise(pairs.cast(whole))
    return per_customer.agg(
        F.sum("n").cast("long").alias("debit_rows"),
        F.sum(joined).cast(whole).alias("joined_rows"),
    )
