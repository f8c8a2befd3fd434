"""Customer features, ratios, rule score and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore import schemas
from spendscore.config import (
    AUDIT_USER,
    BASE_SCORE,
    CORRECTED_LABELS,
    FEATURE_LABELS,
    RECURRING_LABEL,
    SALARY_PERIODS,
    SCORE_BOUNDS,
    SCORE_RULES,
    ScoreRule,
)
from spendscore.functions.casts import lenient_cast
from spendscore.functions.expressions import run_date
from spendscore.operators.silver import recurring_merchants

SUMMARY_COLUMNS = (
    "customer_id", "total_spend", "avg_salary", *FEATURE_LABELS, "recurring_txns", "total_txns",
    "volatility_index", "discretionary_ratio", "fixed_commitment_ratio",
    "salary_to_spend_ratio", "recurring_spend_ratio",
)


def typed_debit(debit: DataFrame) -> DataFrame:
    """Dates and amounts as such, also where a source delivers text."""
    kinds = {"txn_date": T.DateType(), "amount": T.DoubleType()}
    return debit.withColumns(
        {name: lenient_cast(F.col(name), debit.schema[name].dataType, kind) for name, kind in kinds.items()}
    )


def avg_salary(salary: DataFrame) -> DataFrame:
    return salary.groupBy("customer_id").agg(F.avg("salary_amount").alias("avg_salary"))


def daily_features(
    debit: DataFrame,
    labels: Mapping[str, str] = FEATURE_LABELS,
    recurring_label: str = RECURRING_LABEL,
    by: Sequence[str] = ("customer_id", "txn_date"),
) -> DataFrame:
    """Totals, sums per label and counts per customer and day."""
    category, amount = F.col("category"), F.col("amount")
    return debit.groupBy(*by).agg(
        F.sum(amount).alias("total_spend"),
        *[F.sum(F.when(category == label, amount)).alias(name) for name, label in labels.items()],
        F.count(F.lit(1)).alias("total_txns"),
        F.count_if(category == recurring_label).alias("recurring_txns"),
    )


def features_of_days(daily: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS) -> DataFrame:
    """Features per customer out of one row per customer and day."""
    summed = ("total_spend", *labels, "total_txns", "recurring_txns")
    features = daily.groupBy("customer_id").agg(
        *[F.sum(name).alias(name) for name in summed],
        F.stddev("total_spend").alias("volatility_index"),
    )
    # an unknown customer has no volatility: a NULL key would match no row
    known = F.col("customer_id").isNotNull()
    return features.withColumn("volatility_index", F.when(known, F.col("volatility_index")))


def customer_features(
    debit: DataFrame,
    labels: Mapping[str, str] = FEATURE_LABELS,
    recurring_label: str = RECURRING_LABEL,
) -> DataFrame:
    """Totals, sums per label, counts and volatility per customer.

    One roll-up, customer and day first, then customer: the daily sums that
    the volatility needs also carry everything else. Both levels combine
    before their shuffle. A sum over no rows stays NULL here.
    """
    return features_of_days(daily_features(debit, labels, recurring_label), labels)


def debit_features(
    debit: DataFrame,
    labels: Mapping[str, str] = FEATURE_LABELS,
    recurring_label: str = RECURRING_LABEL,
) -> DataFrame:
    """The features without the volatility."""
    return customer_features(debit, labels, recurring_label).drop("volatility_index")


def with_merchant_recurrence(features: DataFrame, debit: DataFrame) -> DataFrame:
    """Count as recurring the transactions of merchants seen more than once."""
    recurring = (
        recurring_merchants(debit)
        .groupBy("customer_id")
        .agg(F.sum("transaction_count").alias("recurring_txns"))
    )
    return features.drop("recurring_txns").join(recurring, "customer_id", "left")


def fill_features(df: DataFrame, include_key: bool = True) -> DataFrame:
    """Zero for every unknown number; by default the customer id as well."""
    if include_key:
        return df.fillna(0)
    return df.fillna(0, subset=[name for name in df.columns if name != "customer_id"])


def gold_summary(
    debit: DataFrame,
    salary: DataFrame,
    *,
    labels: Mapping[str, str] = FEATURE_LABELS,
    recurring_from: str = "label",
    salary_periods: int = SALARY_PERIODS,
    include_key: bool = True,
) -> DataFrame:
    """Features, average salary and ratios of every customer with a debit.

    ``recurring_from`` is "label" (rows labelled as recurring, of which the
    default rules make none) or "merchant_groups" (repeated merchants).
    """
    features = customer_features(debit, labels)
    if recurring_from == "merchant_groups":
        features = with_merchant_recurrence(features, debit)
    elif recurring_from != "label":
        raise ValueError(f"unknown recurring_from: {recurring_from!r}")
    return summary_of(features, salary, salary_periods=salary_periods, include_key=include_key)


def summary_of(
    features: DataFrame,
    salary: DataFrame,
    *,
    salary_periods: int = SALARY_PERIODS,
    include_key: bool = True,
) -> DataFrame:
    """Features with the average salary and the ratios."""
    joined = features.join(avg_salary(salary), "customer_id", "left")
    return add_ratios(fill_features(joined, include_key), salary_periods).select(*SUMMARY_COLUMNS)


def add_ratios(summary: DataFrame, salary_periods: int = SALARY_PERIODS) -> DataFrame:
    """The four ratios; a zero denominator gives NULL."""
    income = F.col("avg_salary") * salary_periods
    spend = F.col("total_spend")
    return summary.withColumns(
        {
            "discretionary_ratio": F.try_divide(F.col("subs") + F.col("misc"), spend),
            "fixed_commitment_ratio": F.try_divide(
                F.col("rent") + F.col("utilities") + F.col("credit"), income
            ),
            "salary_to_spend_ratio": F.try_divide(income, spend),
            "recurring_spend_ratio": F.try_divide(F.col("recurring_txns"), F.col("total_txns")),
        }
    )


def apply_rules(
    df: DataFrame,
    rules: Sequence[ScoreRule] = SCORE_RULES,
    base: int = BASE_SCORE,
    bounds: tuple[int, int] = SCORE_BOUNDS,
) -> DataFrame:
    """Add ``sds_score``: base minus the points of every rule that holds.

    A comparison with NULL does not hold.
    """
    score = F.lit(base)
    for rule in rules:
        value = F.col(rule.column)
        holds = {">": value > rule.threshold, "<": value < rule.threshold}[rule.comparison]
        score = score - F.when(holds, F.lit(rule.points)).otherwise(F.lit(0))
    low, high = bounds
    return df.withColumn("sds_score", F.least(F.lit(high), F.greatest(F.lit(low), score)))


def score_customers(
    summary: DataFrame,
    as_of: date | None = None,
    *,
    rules: Sequence[ScoreRule] = SCORE_RULES,
    base: int = BASE_SCORE,
) -> DataFrame:
    """The stored score row of every customer in ``summary``."""
    return (
        apply_rules(summary, rules, base)
        .withColumn("score_month", F.date_format(run_date(as_of), "yyyy-MM"))
        .select(*schemas.SCORE.names)
    )


def gold_score(
    debit: DataFrame,
    salary: DataFrame,
    as_of: date | None = None,
    *,
    rules: Sequence[ScoreRule] = SCORE_RULES,
    base: int = BASE_SCORE,
    **summary_options,
) -> DataFrame:
    return score_customers(
        gold_summary(debit, salary, **summary_options), as_of, rules=rules, base=base
    )


def gold_score_corrected(debit: DataFrame, salary: DataFrame, as_of: date | None = None) -> DataFrame:
    """The score with the credit label that exists and real recurrence."""
    return gold_score(
        debit, salary, as_of, labels=CORRECTED_LABELS, recurring_from="merchant_groups"
    )


def add_audit(
    score: DataFrame, by: str = AUDIT_USER, at: datetime | None = None, *, ids: str = "random"
) -> DataFrame:
    """Add an id per row, the run's UTC time and who ran it.

    ``ids`` is "random", or "content": made from customer, month and time, so that a
    repeated run gives the same ids.
    """
    at = at or datetime.now(timezone.utc).replace(tzinfo=None)
    if ids == "random":
        calculation_id = F.uuid()
    elif ids == "content":
        unknown = F.lit("?")
        parts = [F.coalesce(F.col(name).cast("string"), unknown) for name in ("customer_id", "score_month")]
        digest = F.md5(F.concat_ws("|", *parts, F.lit(at.isoformat())).cast("binary"))
        calculation_id = F.regexp_replace(digest, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    else:
        raise ValueError(f"unknown kind of ids: {ids!r}")
    return score.withColumns(
        {
            "calculation_id": calculation_id,
            "calculation_time": F.lit(at.isoformat()),
            "calculated_by": F.lit(by),
        }
    )
