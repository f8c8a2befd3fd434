"""Bronze, silver, gold and reports as one job, or step by step."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.config import AUDIT_USER, PipelineConfig
from spendscore.functions.expressions import run_date
from spendscore.operators import bronze, gold, reports, silver, windows
from spendscore.schemas import DEBIT_TRANSACTIONS, INGESTION_DATE
from spendscore.sources.folders import remove
from spendscore.sources.ledger import finish, is_stored, store_once
from spendscore.sources.readers import read_source
from spendscore.sources.tables import append_audit, read_table, write_table

PREVIEW_ROWS = 10


def get_session(app_name: str = "spendscore", **settings: str) -> SparkSession:
    """A session with the given settings; on a cluster the launcher's hold."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def run_day(spark: SparkSession, as_of: date | None = None) -> date:
    """The date of a run, settled once: given, or the session's today."""
    return as_of or spark.range(1).select(F.current_date()).first()[0]


def run_bronze(
    spark: SparkSession,
    config: PipelineConfig,
    as_of: date | None = None,
    *,
    run: str | None = None,
    on_stored: Callable[[str], None] | None = None,
) -> dict[str, DataFrame]:
    """Conform the four inputs, label the debits, add all five to bronze.

    With ``run``, a name for this load, a ledger keeps which tables it has stored: the same run started
    again, after a failure say, adds only what is missing. ``on_stored`` is told each table's name.
    """
    as_of = run_day(spark, as_of)
    landed = f"{config.root.rstrip('/')}/staging/transactions-{uuid.uuid4().hex}"

    def transactions() -> DataFrame:
        # They feed two outputs, so they are read and conformed once, whatever their source.
        if not is_written:
            conformed = bronze.conform_transactions(read_source(spark, config, "transactions"), as_of)
            conformed.write.parquet(landed)
            is_written.append(conformed.schema)
        # the date is given again, as a constant, by which a writer of partitions needn't sort
        return spark.read.schema(is_written[0]).parquet(landed).withColumn(INGESTION_DATE, run_date(as_of))

    is_written: list = []
    loads: dict[str, Callable[[], DataFrame]] = {
        "salary_income": lambda: bronze.conform_salary(read_source(spark, config, "salary_income"), as_of),
        "transactions": transactions,
        "debit_transactions": lambda: bronze.debit_transactions(transactions()),
        "subscriptions": lambda: bronze.conform_subscriptions(read_source(spark, config, "subscriptions"), as_of),
        "credit_card_statements": lambda: bronze.conform_statements(
            read_source(spark, config, "credit_card_statements"), as_of
        ),
    }
    try:
        for name, load in loads.items():
            if run is None:
                write_table(load(), config, name, mode=config.append_mode, partition_by=[INGESTION_DATE])
            elif not is_stored(spark, config, run, name):
                store_once(load(), config, name, run=run, partition_by=[INGESTION_DATE])
            if on_stored:
                on_stored(name)
    finally:
        remove(spark, landed)
    return {name: read_table(spark, config, name) for name in loads}


def run_silver(
    spark: SparkSession,
    config: PipelineConfig,
    *,
    since: date | None = None,
    months: Sequence[str] | None = None,
    preview: bool = False,
    debit_tables: Sequence[str] = ("debit_transactions",),
) -> dict[str, DataFrame]:
    """Store the debits with year and month, and the pivot of ``months``; return the other features unstored.

    ``debit_tables`` may add "debit_transactions_stream". Silver has a partition per load date.
    With ``append_mode`` "replace_partition" only the dates read (``since``) are replaced and
    earlier ones stay; else the table is written anew.
    """
    columns = DEBIT_TRANSACTIONS.names
    tables = [read_table(spark, config, name, since=since).select(*columns) for name in debit_tables]
    write_table(
        silver.with_year_month(reduce(DataFrame.unionByName, tables)),
        config,
        "debit_transactions_silver",
        mode="replace_partition" if config.append_mode == "replace_partition" else "overwrite",
        partition_by=[INGESTION_DATE],
    )
    stored = read_table(spark, config, "debit_transactions_silver")
    frames = {
        "rolling_rows": windows.rolling_rows(stored),
        "rolling_months": windows.rolling_months(stored),
        "total_spend": windows.with_total_spend(stored),
        "volatility": silver.volatility(stored),
        "recurring_merchants": silver.recurring_merchants(stored),
        "spend_profile": silver.spend_profile(stored),
        "monthly_spend": silver.monthly_spend(stored),
    }
    if months is not None:
        pivot = silver.pivot_months(frames["monthly_spend"], months)
        write_table(pivot, config, "pivot_months", mode="overwrite")
        frames["pivot_months"] = read_table(spark, config, "pivot_months")
    if preview:
        _show(frames, n=PREVIEW_ROWS)
    return {"debit_transactions_silver": stored, **frames}


def run_gold(
    spark: SparkSession,
    config: PipelineConfig,
    as_of: date | None = None,
    *,
    at: datetime | None = None,
    by: str = AUDIT_USER,
    preview: bool = False,
    run: str | None = None,
) -> dict[str, DataFrame]:
    """Score every customer, store the scores, log them for audit.

    The audit log repeats the stored rows; nothing is computed twice. A named ``run`` logs
    its scores once, however often it is started.
    """
    as_of = run_day(spark, as_of)
    debit = gold.typed_debit(read_table(spark, config, "debit_transactions_silver"))
    summary = gold.gold_summary(debit, read_table(spark, config, "salary_income"))
    write_table(
        gold.score_customers(summary, as_of),
        config,
        "score",
        mode=config.score_mode,
        partition_by=["score_month"],
    )
    score = read_table(spark, config, "score").filter(F.col("score_month") == f"{as_of:%Y-%m}")
    audited = gold.add_audit(score, by, at)
    if run is None:
        append_audit(audited, config)
    else:
        store_once(audited, config, "score_audit", run=run, partition_by=[])
    frames = {"summary": summary, "score": score}
    if preview:
        _show(frames, truncate=False)
    return {**frames, "score_audit": read_table(spark, config, "score_audit")}


def run_reports(
    spark: SparkSession, config: PipelineConfig, as_of: date | None = None, *, preview: bool = False
) -> dict[str, DataFrame]:
    """Store the chart data of one month's scores: that of ``as_of``, or the newest."""
    score = read_table(spark, config, "score")
    month = f"{as_of:%Y-%m}" if as_of else score.agg(F.max("score_month")).first()[0]
    score = score.filter(F.col("score_month") == month)
    frames = {
        "score_histogram": reports.score_histogram(score),
        "ratio_counts": reports.ratio_counts(score),
        "ratio_buckets": reports.ratio_buckets(score),
        "spend_boxstats": reports.spend_boxstats(score),
        "spend_outliers": reports.spend_outliers(score),
        "scatter_points": reports.scatter_points(score),
        "spend_share": reports.spend_share(score),
        "top_spenders": reports.top_spenders(score),
        "correlations": reports.correlations(score),
    }
    for name, df in frames.items():
        write_table(df, config, name, mode="overwrite")
    stored = {name: read_table(spark, config, name) for name in frames}
    if preview:
        _show(stored)
    return stored


def run_pipeline(
    spark: SparkSession,
    config: PipelineConfig,
    as_of: date | None = None,
    *,
    at: datetime | None = None,
    months: Sequence[str] | None = None,
    preview: bool = False,
    run: str | None = None,
) -> dict[str, DataFrame]:
    """All four steps in order; the frames they stored or can compute.

    A named ``run`` can be started again after a failure: see ``run_bronze``.
    """
    as_of = run_day(spark, as_of)
    frames = {
        **run_bronze(spark, config, as_of, run=run),
        **run_silver(spark, config, months=months, preview=preview),
        **run_gold(spark, config, as_of, at=at, preview=preview, run=run),
        **run_reports(spark, config, as_of, preview=preview),
    }
    if run is not None:
        finish(spark, config, run)
    return frames


def _show(frames: dict[str, DataFrame], n: int = 20, truncate: bool = True) -> None:
    for name, df in frames.items():
        print(name)
        df.show(n, truncate=truncate)
