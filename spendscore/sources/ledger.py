"""A ledger of stored loads, so that a repeated run adds nothing twice, in append mode too.

A load is written to staging first, then its files are renamed into the table under names that carry
the run, and then noted as finished. Wherever a run stops, its repetition goes on from there: a load that is noted is skipped,
a complete staging is not computed again, and files that have been renamed are no longer in
staging.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spendscore.config import PipelineConfig
from spendscore.sources import folders


def _noted(config: PipelineConfig, run: str, name: str) -> str:
    return f"{config.root.rstrip('/')}/ledger/{run}/{name}"


def _staging(config: PipelineConfig, run: str) -> str:
    return f"{config.root.rstrip('/')}/staging/{run}"


def checked_run(run: str) -> str:
    """A run's name, which becomes part of folder and file names."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.\-]*", run):
        raise ValueError(f"a run is named by letters, digits, dots and hyphens: {run!r}")
    return run


def is_stored(spark: SparkSession, config: PipelineConfig, run: str, name: str) -> bool:
    """Whether this run's load of a table is noted as finished."""
    return folders.exists(spark, f"{_noted(config, run, name)}/_SUCCESS")


def store_once(df: DataFrame, config: PipelineConfig, name: str, *, run: str, partition_by: Sequence[str]) -> bool:
    """Append ``df`` to a table of files unless this run has done so; whether it was stored now.

    ``df`` must be the load that the run stands for: it isn't looked at again
    once staging is complete.
    """
    if config.table_format == "delta":
        raise ValueError("a ledger is for tables of plain files")
    spark = df.sparkSession
    if is_stored(spark, config, checked_run(run), name):
        return False
    staged = f"{_staging(config, run)}/{name}"
    if not folders.exists(spark, f"{staged}/_SUCCESS"):
        df.write.format(config.table_format).mode("overwrite").partitionBy(*partition_by).save(staged)
    for path in _files(spark, staged, len(partition_by)):
        folder, _, file = path.rpartition("/")
        folders.rename(spark, f"{staged}/{path}", f"{config.table_path(name)}/{folder}/{file.replace('part-', f'part-{run}-', 1)}")
    # An empty table is the note: its _SUCCESS appears at once or not at all.
    spark.createDataFrame([], "stored string").write.mode("overwrite").parquet(_noted(config, run, name))
    folders.remove(spark, staged)
    return True


def _files(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The data files of a table with ``depth`` partition columns, relative to it."""
    if not depth:
        return [name for name in folders.names(spark, path) if name.startswith("part-")]
    return [f"{folder}/{file}" for folder in folders.names(spark, path) if "=" in folder
            for file in _files(spark, f"{path}/{folder}", depth - 1)]


def finish(spark: SparkSession, config: PipelineConfig, run: str) -> None:
    """Remove what staging a run has left."""
    folders.remove(spark, _staging(config, run))
