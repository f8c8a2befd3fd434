"""Names in shared folders: listing, renaming and removing, wherever they lie."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _at(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder in order; none if there is no such folder."""
    files, folder = _at(spark, path)
    return sorted(found.getPath().getName() for found in files.listStatus(folder)) if files.exists(folder) else []


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another name, in another folder too, which is made if need be."""
    files, old = _at(spark, source)
    new = _at(spark, target)[1]
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, folder = _at(spark, path)
    files.delete(folder, True)


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of partitions ``key=number`` in a folder, in order."""
    start = f"{key}="
    return sorted(int(name[len(start):]) for name in names(spark, path) if name.startswith(start) and name[len(start):].lstrip("-").isdigit())
