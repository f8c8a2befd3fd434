"""Stored tables of the layers: read, append, overwrite, replace a partition."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.config import PipelineConfig
from spendscore.schemas import INGESTION_DATE, STORED
from spendscore.sources.batches import read_batches

#: Tables that a stream writes by batches, which may be folded.
STREAMED = ("debit_transactions_stream", "daily_spend_stream")


def read_table(
    spark: SparkSession,
    config: PipelineConfig,
    name: str,
    *,
    since: date | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A stored table; ``since`` prunes load dates before it.

    It has its declared columns, NULL in files that lack them. With
    ``merge_schema`` it has every column that some load added, for which Spark
    reads the footers of all files. Of a stream's table the newest snapshot and the batches beyond it
    are read, see ``batches``.
    """
    reader, path = spark.read.format(config.table_format), config.table_path(name)
    declared = STORED.get(name)
    if name in STREAMED and config.table_format == "parquet":
        table = read_batches(spark, config, name)
    elif config.table_format == "delta":
        table = reader.load(path)
    elif merge_schema or declared is None:
        table = reader.option("mergeSchema", "true").load(path)
    else:
        table = reader.schema(declared).load(path).select(*declared.names)
    return table if since is None else table.filter(F.col(INGESTION_DATE) >= F.lit(since))


def write_table(
    df: DataFrame,
    config: PipelineConfig,
    name: str,
    *,
    mode: str = "append",
    partition_by: Sequence[str] = (),
) -> None:
    """Write ``df`` as table ``name``.

    ``mode`` is "append", "overwrite" (the whole table, which may change its
    columns) or "replace_partition" (only the partitions ``df`` has rows for).
    """
    if mode not in ("append", "overwrite", "replace_partition"):
        raise ValueError(f"unknown mode: {mode!r}")
    if mode == "replace_partition" and not partition_by:
        raise ValueError("replace_partition needs partition columns")
    writer = df.write.format(config.table_format).mode("append" if mode == "append" else "overwrite")
    if config.table_format == "delta":
        schema_option = "overwriteSchema" if mode == "overwrite" else "mergeSchema"
        writer = writer.option(schema_option, "true")
    writer = writer.option(
        "partitionOverwriteMode", "dynamic" if mode == "replace_partition" else "static"
    )
    writer.partitionBy(*partition_by).save(config.table_path(name))


def append_audit(audited: DataFrame, config: PipelineConfig) -> None:
    write_table(audited, config, "score_audit", mode="append")
