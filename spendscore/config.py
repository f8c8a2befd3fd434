"""Settings, rule tables and label maps. Everything here is data."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# Category labels with the merchant substrings that select
# them, in match order, and the label for everything else.
CATEGORY_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Rent", ("zillow", "rentpay", "landlord")),
    ("Utilities", ("hydro", "enbridge", "telus")),
    ("Subscriptions", ("netflix", "spotify", "amazon prime")),
    ("Food & Groceries", ("zomato", "costco", "uber eats", "uber", "swiggy")),
    ("Credit Repayment", ("visa", "amex", "emi")),
    (
        "Misc. Discretionary",
        ("amazon", "shopping", "flipkart", "uber", "bigbazaar", "myntra", "flights"),
    ),
)
OTHER_CATEGORY = "Other"

# Example merchants per category for the nearest-example match.
CATEGORY_EXAMPLES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Rent", ("Zillow", "RentPay", "Landlord")),
    ("Utilities", ("BC Hydro", "Enbridge", "Telus")),
    ("Subscriptions", ("Netflix", "Spotify", "Amazon Prime")),
    ("Food & Groceries", ("Zomato", "Costco", "Uber Eats")),
    ("Credit Repayment", ("Visa", "AMEX", "EMI Portal")),
    ("Misc. Discretionary", ("Amazon", "Shopping", "Flights")),
)

# Feature column -> category label it sums. No category rule
# produces "Credit Card Payment" or "Recurring", so with the default rules
# `credit` and `recurring_txns` are always zero; CORRECTED_LABELS names the
# label the rules do produce.
FEATURE_LABELS: Mapping[str, str] = {
    "subs": "Subscriptions",
    "misc": "Misc. Discretionary",
    "rent": "Rent",
    "utilities": "Utilities",
    "credit": "Credit Card Payment",
}
RECURRING_LABEL = "Recurring"
CORRECTED_LABELS: Mapping[str, str] = {**FEATURE_LABELS, "credit": "Credit Repayment"}


@dataclass(frozen=True)
class ScoreRule:
    """Subtract ``points`` where ``column`` lies beyond ``threshold``."""

    column: str
    comparison: str  # ">" or "<", always strict
    threshold: float
    points: int


# Start score, bounds, salary periods and penalty rules.
BASE_SCORE = 650
SCORE_BOUNDS = (0, 900)
SALARY_PERIODS = 3
SCORE_RULES: tuple[ScoreRule, ...] = (
    ScoreRule("discretionary_ratio", ">", 0.5, 50),
    ScoreRule("fixed_commitment_ratio", ">", 0.6, 100),
    ScoreRule("salary_to_spend_ratio", "<", 1, 150),
    ScoreRule("volatility_index", ">", 20000, 75),
    ScoreRule("recurring_spend_ratio", "<", 0.2, 25),
)

AUDIT_USER = "auto_pipeline"

# Layer and directory of every stored table.
TABLE_PATHS: Mapping[str, str] = {
    "salary_income": "bronze/salary_income",
    "transactions": "bronze/transactions",
    "debit_transactions": "bronze/debit_transactions",
    "subscriptions": "bronze/subscriptions",
    "credit_card_statements": "bronze/credit_card_statements",
    "debit_transactions_silver": "silver/debit_transactions_silver",
    "score": "gold/data_products_sds_financial_health_score",
    "score_audit": "audit_log/sds_score_audit",
    "debit_transactions_stream": "bronze/debit_transactions_stream",
    "daily_spend_stream": "silver/daily_spend_stream",
    "daily_spend_open": "silver/daily_spend_open",
    "daily_spend_closed": "silver/daily_spend_closed",
    "daily_spend_late": "silver/daily_spend_late",
    "feature_state": "silver/feature_state",
    "pivot_months": "silver/pivot_months",
    **{
        name: f"reports/{name}"
        for name in (
            "score_histogram", "ratio_counts", "ratio_buckets", "spend_boxstats", "spend_outliers",
            "scatter_points", "spend_share", "top_spenders", "correlations",
        )
    },
}


@dataclass(frozen=True)
class JdbcPartition:
    """Column range that splits one JDBC table over several read tasks."""

    column: str
    lower: str
    upper: str
    count: int


@dataclass(frozen=True)
class JdbcConfig:
    """Connection settings. The password comes from the environment."""

    url: str
    user: str | None = None
    driver: str | None = None
    password_env: str = "SPENDSCORE_JDBC_PASSWORD"
    fetch_size: int = 10_000

    @property
    def password(self) -> str | None:
        return os.environ.get(self.password_env)


@dataclass(frozen=True)
class SourceSpec:
    """Where one raw input comes from: a file path or a JDBC table."""

    format: str  # "jdbc", "parquet", "csv", "orc", "json" or any Spark format
    location: str  # path, or table name for "jdbc"
    options: Mapping[str, str] = field(default_factory=dict)
    partition: JdbcPartition | None = None
    # conditions that split a JDBC table where no column range does
    predicates: Sequence[str] = ()
    schema: str | None = None  # as DDL, for files; CSV without one is read as text


@dataclass(frozen=True)
class PipelineConfig:
    """Everything one run needs to know besides the session.

    ``append_mode`` is "append" (a second run adds the rows again) or
    "replace_partition" (a second run on the same day replaces that day).
    ``score_mode`` is "overwrite" (only the newest month is kept) or
    "replace_partition" (earlier months stay).
    """

    root: str
    sources: Mapping[str, SourceSpec] = field(default_factory=dict)
    jdbc: JdbcConfig | None = None
    table_format: str = "parquet"
    append_mode: str = "append"
    score_mode: str = "overwrite"

    def table_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{TABLE_PATHS[name]}"

    @staticmethod
    def from_json(path: str) -> PipelineConfig:
        """Read the settings file (see README for its layout)."""
        with open(path, encoding="utf-8") as handle:
            raw = json.load(handle)
        jdbc = raw.get("jdbc")
        if jdbc is not None and "password" in jdbc:
            raise ValueError("keep the JDBC password in the environment, not in the file")
        return PipelineConfig(
            root=raw["root"],
            sources={name: _source(spec) for name, spec in raw.get("sources", {}).items()},
            jdbc=JdbcConfig(**jdbc) if jdbc is not None else None,
            **{
                key: raw[key]
                for key in ("table_format", "append_mode", "score_mode")
                if key in raw
            },
        )


def _source(raw: Mapping) -> SourceSpec:
    partition = raw.get("partition")
    return SourceSpec(
        format=raw["format"],
        location=raw["location"],
        options=dict(raw.get("options", {})),
        partition=JdbcPartition(**partition) if partition else None,
        predicates=tuple(raw.get("predicates", ())),
        schema=raw.get("schema"),
    )
