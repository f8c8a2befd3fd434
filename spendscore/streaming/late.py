"""Daily spend from a stream that keeps the rows that come too late.

Spark's own watermark drops them without a trace. Here each batch is dealt in two by the watermark that held before
it: rows of open days go into the open sums, rows of closed days into a table of their own. Days that the batch
closes leave the open sums for the table of closed days. A correction step adds both up.

All state is in tables, one partition per batch, computed from the partition of the batch before:
a repeated batch computes and replaces the same.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendscore.config import PipelineConfig
from spendscore.sources import folders
from spendscore.sources.batches import read_batches

OPEN, CLOSED, LATE = "daily_spend_open", "daily_spend_closed", "daily_spend_late"
_DAYS = "customer_id int, txn_date date, daily_spend double, rows long, newest timestamp_ntz"


def _part(config: PipelineConfig, name: str, batch: int) -> str:
    return f"{config.table_path(name)}/batch={batch}"


def _closing(newest: datetime | None, delay: timedelta) -> datetime | None:
    """The watermark: a day whose end isn't after it is closed."""
    return None if newest is None else newest - delay


def store_batch(rows: DataFrame, batch: int, config: PipelineConfig, delay: timedelta) -> None:
    """One batch of ``rows(customer_id, ts, amount)``: late rows, closed days and the new open sums.

    Rows without a time belong to no day; they are stored as late ones and no sum counts them.
    """
    spark = rows.sparkSession
    numbers = [b for b in folders.numbered(spark, config.table_path(OPEN), "batch") if b < batch]
    before = spark.read.schema(_DAYS).parquet(_part(config, OPEN, numbers[-1])) if numbers else spark.createDataFrame([], _DAYS)
    seen = before.agg(F.max("newest")).first()[0]
    watermark = _closing(seen, delay)
    day_end = (F.col("txn_date") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    timed = rows.select(F.col("customer_id").cast("int").alias("customer_id"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                        F.col("amount").cast("double").alias("amount")).withColumn("txn_date", F.to_date("ts"))
    timed = timed.persist()
    late = F.col("ts").isNull() if watermark is None else F.col("ts").isNull() | (day_end <= F.lit(watermark).cast("timestamp_ntz"))
    timed.filter(late).write.mode("overwrite").parquet(_part(config, LATE, batch))
    fresh = timed.filter(~late).groupBy("customer_id", "txn_date").agg(
        F.sum("amount").alias("daily_spend"), F.count(F.lit(1)).alias("rows"), F.max("ts").alias("newest"))
    # The newest time of all is kept in rows of its own, which have no rows of input, as all days may be closed.
    newest = max((t for t in (seen, timed.agg(F.max("ts")).first()[0]) if t is not None), default=None)
    mark = spark.createDataFrame([(None, None, None, 0, newest)], _DAYS)
    days = (
        before.filter("rows > 0").unionByName(fresh).groupBy("customer_id", "txn_date")
        .agg(F.sum("daily_spend").alias("daily_spend"), F.sum("rows").alias("rows"), F.max("newest").alias("newest"))
    )
    after = _closing(newest, delay)
    closed = F.lit(False) if after is None else day_end <= F.lit(after).cast("timestamp_ntz")
    days.filter(closed).select("customer_id", "txn_date", "daily_spend").write.mode("overwrite").parquet(_part(config, CLOSED, batch))
    days.filter(~closed).unionByName(mark).write.mode("overwrite").parquet(_part(config, OPEN, batch))
    timed.unpersist()
    # The batch before is needed if this one is repeated; older open sums are not.
    for old in numbers[:-1]:
        folders.remove(spark, _part(config, OPEN, old))


def stream_daily_spend_kept(
    events: DataFrame, config: PipelineConfig, checkpoint: str, *, delay: timedelta = timedelta(days=2), trigger: dict | None = None
) -> StreamingQuery:
    """Daily spend of ``events(customer_id, ts, amount)`` as closed days, open sums and late rows, all stored.

    A day closes as soon as the stream is ``delay`` past its end. Only open days are state: each batch reads and
    writes their sums, whatever has been closed before.
    """
    return (
        events.writeStream.foreachBatch(lambda rows, batch: store_batch(rows, batch, config, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_spend(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """What late rows add to days that were closed without them."""
    return (
        read_batches(spark, config, LATE).filter("ts IS NOT NULL").groupBy("customer_id", "txn_date")
        .agg(F.sum("amount").alias("daily_spend"), F.count(F.lit(1)).alias("late_rows"))
    )


def corrected_daily_spend(spark: SparkSession, config: PipelineConfig, *, with_open: bool = False) -> DataFrame:
    """Closed days with the late rows folded in; with the open days too, if wanted.

    Per customer and day: daily_spend and how many of its rows came late. A day of late rows alone is
    there as well. Run it as often as you like: the stored days and rows stay as they are.
    """
    columns = ["customer_id", "txn_date", "daily_spend"]
    parts = read_batches(spark, config, CLOSED).select(*columns, F.lit(0).cast("long").alias("late_rows"))
    parts = parts.unionByName(late_spend(spark, config).select(*columns, "late_rows"))
    if with_open:
        numbers = folders.numbered(spark, config.table_path(OPEN), "batch")
        days = spark.read.schema(_DAYS).parquet(_part(config, OPEN, numbers[-1])).filter("rows > 0")
        parts = parts.unionByName(days.select(*columns, F.lit(0).cast("long").alias("late_rows")))
    return parts.groupBy("customer_id", "txn_date").agg(
        F.sum("daily_spend").alias("daily_spend"), F.sum("late_rows").alias("late_rows"))
