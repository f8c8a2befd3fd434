"""Raw inputs: JDBC tables and files."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendscore.config import JdbcConfig, JdbcPartition, PipelineConfig, SourceSpec
from spendscore.schemas import STORED, as_text


def jdbc_options(
    config: JdbcConfig, table: str, partition: JdbcPartition | None = None
) -> dict[str, str]:
    """Reader options for one table; with a partition, for a parallel read."""
    options = {
        "url": config.url,
        "dbtable": table,
        "user": config.user,
        "password": config.password,
        "driver": config.driver,
        "fetchsize": str(config.fetch_size),
    }
    if partition is not None:
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": partition.lower,
            "upperBound": partition.upper,
            "numPartitions": str(partition.count),
        }
    return {name: value for name, value in options.items() if value is not None}


def read_jdbc(
    spark: SparkSession,
    config: JdbcConfig,
    table: str,
    partition: JdbcPartition | None = None,
    options: Mapping[str, str] | None = None,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """One database table.

    A task reads a range of the ``partition`` column, or the rows of one of the
    ``predicates``, which must not overlap; without either a single task reads all of it.
    """
    if partition is not None and predicates:
        raise ValueError("give a partition column or predicates, not both")
    settings = {**jdbc_options(config, table, partition), **(options or {})}
    if predicates:
        properties = {name: value for name, value in settings.items() if name not in ("url", "dbtable")}
        return spark.read.jdbc(config.url, table, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(**settings).load()


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Files of any format Spark reads.

    CSV has a header. With a schema it has to name the same columns, and nothing is read to
    open the files; without one all columns are text, named after the first line. Types
    are inferred, by a pass over the data, only where ``inferSchema`` asks for it.
    """
    defaults = {"header": "true"} if fmt == "csv" else {}
    if fmt == "csv" and schema is not None:
        defaults["enforceSchema"] = "false"
    reader = spark.read.format(fmt).options(**{**defaults, **options})
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_source(spark: SparkSession, config: PipelineConfig, name: str) -> DataFrame:
    """The raw input ``name`` as the settings describe it."""
    source: SourceSpec = config.sources[name]
    if source.format == "jdbc":
        if config.jdbc is None:
            raise ValueError(f"source {name!r} is a JDBC table, but no connection is set")
        if name == "transactions" and source.partition is None and not source.predicates:
            warnings.warn("transactions are read by one task: set partition or predicates", stacklevel=2)
        return read_jdbc(
            spark, config.jdbc, source.location, source.partition, source.options, source.predicates
        )
    schema = source.schema
    if schema is None and source.format == "csv" and "inferSchema" not in source.options and name in STORED:
        schema = as_text(STORED[name])
    return read_files(spark, source.location, source.format, schema, **source.options)
