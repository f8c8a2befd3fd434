"""Helpers the operators share: input tables, written intermediate tables, seeded numbers."""

from __future__ import annotations

import contextlib
import ctypes
import ctypes.util
import functools
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.sources.workdir import work_dir

#: Bytes of a shuffle partition that is still handled well by one task.
PARTITION_BYTES = 64 << 20

SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The driver's own copies of what ``shipped`` serves, removed when it ends.
_ARCHIVES: list[tempfile.TemporaryDirectory] = []


def shipped(spark: SparkSession) -> SparkSession:
    """The session, made ready for Python workers.

    They get this package once (like ``--py-files``) and, unless the launcher has said otherwise,
    texts in batches small enough to hold a few copies of.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    if not any("/spendscore-llm-" in file for file in context.listFiles):
        package = Path(__file__).resolve().parents[1]
        _ARCHIVES.append(folder := tempfile.TemporaryDirectory(prefix="spendscore-"))
        name = f"{Path(folder.name).resolve()}/spendscore-llm-{uuid.uuid4().hex}.zip"
        with zipfile.ZipFile(name, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(name)
    return spark


#: What clears the caches of each module, and the module whose function this worker ran last.
_CACHES: dict[str, list[Callable[[], None]]] = {}
_LAST: list[str] = []


def forgettable(module: str, clear: Callable[[], None]) -> None:
    """Say how a module's cache is cleared when a worker goes on to another module's work."""
    _CACHES.setdefault(module, []).append(clear)


@functools.cache
def _libc() -> ctypes.CDLL | None:
    name = ctypes.util.find_library("c")
    library = ctypes.CDLL(name) if name else None
    return library if hasattr(library, "malloc_trim") else None


@functools.cache
def settled() -> None:
    """Keep what a Python worker has imported out of the garbage collections that follow each of its tasks, once per worker.

    They go through all modules' objects, 45 ms of CPU time each.
    """
    gc.freeze()


def tidied(function):
    """A function over a task's batches that leaves no memory behind.

    Spark uses Python workers again: what one operator's caches and allocators keep would stay through
    all that follow. Caches of other modules go before the first batch, freed memory goes back after the last.
    """
    owner = function.__module__

    @functools.wraps(function)
    def run(batches, *args, **options):
        if _LAST != [owner]:
            for module, clears in _CACHES.items():
                if module != owner:
                    for clear in clears:
                        clear()
            _LAST[:] = [owner]
        try:
            yield from function(batches, *args, **options)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if library := _libc():
                library.malloc_trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where the table has columns so called, whatever their case."""
    taken = {column.lower() for column in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    Cuts the lineage: what follows starts from the files, whichever executors
    are lost. The folder is the session's ``spark.checkpoint.dir``.
    """
    return written_at(df, purpose)[0]


def written_at(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``written``, and the folder, for ``removed``."""
    path = f"{work_dir(df.sparkSession, purpose)}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Remove written tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Within it, a job's shuffle files go when the job ends, instead of when the driver next collects its garbage."""
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_REMOVED)
        else:
            spark.conf.set(SHUFFLES_REMOVED, before)


def in_training(doc_id: str | Column = "doc_id") -> Column:
    """Rows to learn from: the checksum of the id as text, modulo 4, is not 2."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return ~held_out(key)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows kept from training; an unknown id counts as held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over the whole range (a fixed bijection)."""
    with np.errstate(over="ignore"):
        v = values.astype(np.uint64, copy=True)
        v ^= v >> np.uint64(33)
        v *= np.uint64(0xFF51AFD7ED558CCD)
        v ^= v >> np.uint64(33)
        v *= np.uint64(0xC4CEB9FE1A85EC53)
        v ^= v >> np.uint64(33)
    return v
