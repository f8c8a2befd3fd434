"""Customer features kept up to date load by load, without going over all history again."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.config import FEATURE_LABELS, PipelineConfig
from spendscore.operators import gold
from spendscore.schemas import INGESTION_DATE
from spendscore.sources import folders
from spendscore.sources.tables import read_table, write_table

STATE = "feature_state"
DAY = ("customer_id", "txn_date")


def load_state(debit: DataFrame, load: date, labels: Mapping[str, str] = FEATURE_LABELS) -> DataFrame:
    """What one load of debits adds to each customer's days; only its partition of ``debit`` is read."""
    rows = gold.typed_debit(debit.filter(F.col(INGESTION_DATE) == F.lit(load)))
    return gold.daily_features(rows, labels, by=(INGESTION_DATE, *DAY))


def update_features(
    spark: SparkSession,
    config: PipelineConfig,
    load: date,
    *,
    debit_table: str = "debit_transactions_silver",
    labels: Mapping[str, str] = FEATURE_LABELS,
) -> None:
    """Replace what the state holds of ``load`` by what the stored debits of that date hold now.

    A load that comes a second time, or is corrected, takes the place of its earlier state; one that is
    gone is removed.
    """
    state = load_state(read_table(spark, config, debit_table), load, labels)
    if state.isEmpty():
        folders.remove(spark, f"{config.table_path(STATE)}/{INGESTION_DATE}={load.isoformat()}")
    else:
        write_table(state, config, STATE, mode="replace_partition", partition_by=[INGESTION_DATE])


def days_of_state(state: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS) -> DataFrame:
    """The customers' days over all loads. A day that several loads have rows of is added up first,
    so counts, sums and the days' spread are those of all rows, however they were dealt to loads."""
    names = ("total_spend", *labels, "total_txns", "recurring_txns")
    return state.groupBy(*DAY).agg(*[F.sum(name).alias(name) for name in names])


def summary_from_state(
    spark: SparkSession, config: PipelineConfig, salary: DataFrame, labels: Mapping[str, str] = FEATURE_LABELS, **options
) -> DataFrame:
    """``gold_summary`` out of the state: its rows are customers' days, not transactions."""
    days = days_of_state(read_table(spark, config, STATE), labels)
    return gold.summary_of(gold.features_of_days(days, labels), salary, **options)
