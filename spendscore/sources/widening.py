"""Tables whose columns change their type from load to load."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendscore.config import PipelineConfig
from spendscore.sources import folders

#: Numbers from narrow to wide; each can hold what those before it hold, but for the last bits of a long as a double.
_NUMBERS: tuple[type[T.DataType], ...] = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def wider(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type that holds both: the wider number, timestamps for dates, else text."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if type(left) in _NUMBERS and type(right) in _NUMBERS:
        low, high = sorted((type(left), type(right)), key=_NUMBERS.index)
        # a float can't hold every int
        return T.DoubleType() if high is T.FloatType and low in (T.IntegerType, T.LongType) else high()
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        return T.DecimalType(min(38, max(left.precision - left.scale, right.precision - right.scale) + scale), scale)
    if {type(left), type(right)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(left, T.DecimalType) or isinstance(right, T.DecimalType):
        other = right if isinstance(left, T.DecimalType) else left
        if type(other) in _NUMBERS:
            return T.DoubleType()
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)
    if isinstance(left, nested) or isinstance(right, nested):
        raise ValueError(f"no type holds both {left.simpleString()} and {right.simpleString()}")
    return T.StringType()


def widened(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of some schemas in the order they first appear, each in the type that holds all of its own."""
    kinds: dict[str, T.DataType] = {}
    for field in (field for schema in schemas for field in schema):
        kinds[field.name] = wider(kinds[field.name], field.dataType) if field.name in kinds else field.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _schemas_path(config: PipelineConfig, name: str) -> str:
    return f"{config.root.rstrip('/')}/schemas/{name}"


def write_load(df: DataFrame, config: PipelineConfig, name: str, *, load: str, by: str, mode: str = "append") -> None:
    """Write one load, a partition ``by=load``, and keep its schema beside the table.

    ``mode`` is "append" or "overwrite" (the load's earlier rows go). Every load keeps the types it came
    with; loads of one schema are read together.
    """
    rows = df.drop(by)
    kept = f"{_schemas_path(config, name)}/{by}={load}"
    earlier = folders.exists(df.sparkSession, kept) and mode == "append"
    if earlier and _schema(df.sparkSession, kept) != rows.schema:
        raise ValueError(f"load {load} of {name} has rows of other types already")
    rows.write.format("parquet").mode(mode).save(f"{config.table_path(name)}/{by}={load}")
    spark = df.sparkSession
    spark.createDataFrame([(rows.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").json(kept)


def _schema(spark: SparkSession, kept: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.schema("schema string").json(kept).first()["schema"]))


def read_widened(spark: SparkSession, config: PipelineConfig, name: str, *, by: str, kind: str = "date") -> DataFrame:
    """A table of ``write_load`` with all columns that some load has, in types that hold them all.

    The schemas kept are read, not the files' footers. Loads of one schema are one scan, so the plan has a branch per schema,
    not per load; missing columns are NULL. Conditions on ``by`` prune loads.
    """
    kept = spark.read.schema(f"schema string, `{by}` string").json(_schemas_path(config, name))
    per_schema = kept.groupBy("schema").agg(F.sort_array(F.collect_list(by)).alias("loads")).collect()
    found = sorted(((row["loads"], row["schema"]) for row in per_schema), key=lambda x: x[0][0])
    kinds = [T.StructType.fromJson(json.loads(schema)) for _, schema in found]
    whole = widened(kinds)
    parts = []
    for (loads, _), schema in zip(found, kinds):
        path = config.table_path(name)
        rows = (spark.read.schema(T.StructType([*schema, T.StructField(by, T._parse_datatype_string(kind))])).option("basePath", path)
                .parquet(*[f"{path}/{by}={load}" for load in loads]))
        own = {field.name for field in schema}
        parts.append(rows.select(
            *[(F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole], F.col(f"`{by}`")))
    return reduce(DataFrame.unionByName, parts)
