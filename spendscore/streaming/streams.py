"""Transactions and daily spend from a stream of files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendscore.config import CATEGORY_RULES, PipelineConfig
from spendscore.operators.bronze import conform_transactions, debit_transactions
from spendscore.sources.tables import write_table


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """New files of a folder as a stream. The schema has to be declared."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def stream_debit(raw: DataFrame, as_of: date | None = None, rules=CATEGORY_RULES) -> DataFrame:
    """Conform, filter and label a stream of raw transactions.

    Without state: the same functions as in the batch job.
    """
    return debit_transactions(conform_transactions(raw, as_of), rules)


def stream_daily_spend(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Spend per customer and day of ``events(customer_id, ts, amount)``.

    A day stays open until the stream is ``delay`` past its end; rows that
    come later than that are dropped. State is one sum per open (customer, day).
    """
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("day"), "customer_id")
        .agg(F.sum("amount").alias("daily_spend"))
        .select("customer_id", F.to_date("day.start").alias("txn_date"), "daily_spend")
    )


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Append a stream to files, each row once also after a restart.

    By default it takes everything that is there and stops. Keep the output
    apart from batch tables: its readers trust the log the stream writes.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def stream_to_table(
    df: DataFrame,
    config: PipelineConfig,
    name: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    output_mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream into a stored table that later steps read.

    The table has a ``batch`` column and a partition per batch, which a repeated batch
    replaces: a restart neither loses nor doubles rows. ``batches.compact`` folds closed batches. In mode "update" a batch holds
    the rows that it has changed, see ``latest_rows``.
    """

    def store(rows: DataFrame, batch: int) -> None:
        numbered = rows.withColumn("batch", F.lit(batch).cast("long"))
        write_table(numbered, config, name, mode="replace_partition", partition_by=["batch", *partition_by])

    return (
        df.writeStream.foreachBatch(store)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of a table that a stream in mode "update" has written, each key's newest row."""
    values = [name for name in table.columns if name not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("_row")
    return table.groupBy(*keys).agg(newest).select(*keys, "_row.*")
