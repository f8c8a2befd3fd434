"""Stream-written tables with few partitions: closed batches are folded into one snapshot.

``stream_to_table`` writes a partition per batch. ``compact`` reads the snapshot there is and the batches after it, up to
the last one that the stream's checkpoint has committed, and writes a new snapshot, ``<table>_folded/upto=<batch>``,
which appears at once, with its success file. Readers take the newest snapshot and the batches beyond it, so
they see every row once, before and after. Only the last, uncommitted batch can be repeated by
the stream, and it is never folded; a batch that is repeated all the same, after a checkpoint was put back, writes a
partition that readers pass over. What a snapshot replaces is removed by a later fold, so a reader
that has listed its files before a fold can finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.config import PipelineConfig
from spendscore.schemas import STORED
from spendscore.sources import folders


def _folded(config: PipelineConfig, name: str) -> str:
    return f"{config.table_path(name)}_folded"


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a stream has finished for good, -1 if none."""
    done = [int(name) for name in folders.names(spark, f"{checkpoint.rstrip('/')}/commits") if name.isdigit()]
    return max(done, default=-1)


def snapshots(spark: SparkSession, config: PipelineConfig, name: str) -> list[int]:
    """The batches up to which there is a complete snapshot, in order."""
    path = _folded(config, name)
    return [upto for upto in folders.numbered(spark, path, "upto") if folders.exists(spark, f"{path}/upto={upto}/_SUCCESS")]


def _batches(spark: SparkSession, config: PipelineConfig, name: str, after: int, upto: int | None = None) -> list[int]:
    found = folders.numbered(spark, config.table_path(name), "batch")
    return [batch for batch in found if batch > after and (upto is None or batch <= upto)]


def _rows(spark: SparkSession, config: PipelineConfig, name: str, snapshot: int | None, batches: Sequence[int]) -> DataFrame:
    path, declared = config.table_path(name), STORED.get(name)
    newer = [f"{path}/batch={batch}" for batch in batches]
    reader = spark.read if declared is None else spark.read.schema(declared)
    kept = None if snapshot is None else reader.parquet(f"{_folded(config, name)}/upto={snapshot}")
    if not newer:
        if kept is None:
            raise ValueError(f"{name} has no batch yet")
        return kept if declared is None else kept.select(*declared.names)
    reader = spark.read.option("basePath", path)
    if declared is None and kept is None:
        reader = reader.option("mergeSchema", "true")
    else:
        reader = reader.schema(declared or kept.schema)
    fresh = reader.parquet(*newer).withColumn("batch", F.col("batch").cast("long"))
    names = declared.names if declared else (fresh if kept is None else kept).columns
    return fresh.select(*names) if kept is None else kept.select(*names).unionByName(fresh.select(*names))


def read_batches(spark: SparkSession, config: PipelineConfig, name: str) -> DataFrame:
    """All rows of a stream-written table, with their ``batch``: the newest snapshot and the batches beyond it."""
    done = snapshots(spark, config, name)
    return _rows(spark, config, name, done[-1] if done else None, _batches(spark, config, name, done[-1] if done else -1))


def compact(
    spark: SparkSession,
    config: PipelineConfig,
    name: str,
    checkpoint: str,
    *,
    keys: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    rows_per_file: int = 5_000_000,
) -> int:
    """Fold all committed batches; the batch up to which the table is folded now, -1 if there is nothing to fold.

    With ``keys``, for a stream in mode "update", only each key's newest row is kept, so the table no longer grows with
    every change. A snapshot has the partitions ``partition_by``, so that readers go on pruning them. After two folds there are as many partitions as batches since the first one, and two snapshots.
    """
    upto, done = committed_batch(spark, checkpoint), snapshots(spark, config, name)
    last = done[-1] if done else -1
    batches = _batches(spark, config, name, last, upto)
    if batches:
        rows = _rows(spark, config, name, last if done else None, batches)
        if keys:
            values = [column for column in rows.columns if column not in keys]
            newest = F.max_by(F.struct(*values), "batch").alias("_row")
            rows = rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")
        # A file per stated number of rows; a part of a snapshot that was left half-written is replaced.
        files = max(1, -(-rows.count() // rows_per_file))
        dealt = rows.repartition(files, *partition_by, F.pmod(F.xxhash64(*rows.columns), F.lit(files))) if partition_by else rows.repartition(files)
        dealt.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{_folded(config, name)}/upto={batches[-1]}")
    for batch in folders.numbered(spark, config.table_path(name), "batch"):
        if batch <= last:
            folders.remove(spark, f"{config.table_path(name)}/batch={batch}")
    for old in done[:-1]:
        folders.remove(spark, f"{_folded(config, name)}/upto={old}")
    return batches[-1] if batches else last
