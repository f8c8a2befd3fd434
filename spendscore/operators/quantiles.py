"""Exact quantiles of a few large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscore.operators.skew import few_groups, join_by_key
from spendscore.sources.folders import remove
from spendscore.sources.workdir import work_dir

#: Parts that a round cuts a range into, if it still has too many rows.
_PARTS = 64
#: What tells a range: its group, the group's rows, its ends (the lower one outside) and the rows before it.
_RANGE = ("_n", "_above", "_upto", "_before")


def grouped_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    quantiles: dict[str, float],
    *,
    margin: float = 0.002,
    accuracy: int = 10_000,
    max_groups: int = 100_000,
    max_rows: int = 1_000_000,
) -> DataFrame:
    """Interpolated quantiles per group: one column per entry of ``quantiles``.

    ``group`` must have few values (a clamped score, a bucket): a few small rows
    per group are broadcast, and more than ``max_groups`` fail. The groups themselves may be of any size:

    1. a sketch proposes bounds closely around each quantile;
    2. rows are counted by the ranges between the bounds, which tells exactly
       which range holds which rank;
    3. a range that holds a rank and has more than ``max_rows`` rows of different values is cut
       again by a sketch of its own, round by round until there is none;
    4. only the values of those narrow ranges are shuffled, counted by value
       and walked in order: at most ``max_rows`` of a range, or one value with its count.

    The sketches decide how narrow the ranges are, never the result. ``df`` is
    read more than once, also while this function runs (it looks once a round whether a range is too large), and has to give
    the same values each time: a stored table, or sums rounded to what they stand for.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(value).isNotNull()).select(group, value)
    few = few_groups(rows, group, max_groups)
    cuts = sorted(
        {
            min(max(q + side * margin, 0.0), 1.0)
            for q in quantiles.values()
            for side in (-1, 1)
        }
    )
    end = F.lit(None).cast(rows.schema[value].dataType)
    whole = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx(value, cuts, accuracy).alias("_edges"),
    ).filter(few).withColumns({"_above": end, "_upto": end, "_before": F.lit(0).cast("long")})

    def kept(ranges: DataFrame, purpose: str) -> tuple[DataFrame, str]:
        path = work_dir(spark, purpose)
        ranges.write.parquet(path)
        return spark.read.schema(ranges.schema).parquet(path), path

    ranges, path = kept(_narrowed(rows, whole, group, value, quantiles), "quantile-ranges")
    large = (F.col("_size") > max_rows) & (F.col("_least") < F.col("_most"))
    while not ranges.filter(large).isEmpty():
        edges = _edges(rows, ranges.filter(large), group, value, accuracy)
        cut = _narrowed(rows, edges, group, value, quantiles)
        again, new_path = kept(ranges.filter(~large).unionByName(cut), "quantile-ranges")
        remove(spark, path)
        ranges, path = again, new_path
    return _walked(rows, ranges, group, value, quantiles)


def _position(q: float) -> Column:
    return F.lit(q) * (F.col("_n") - 1)


def _ranks_within(quantiles: dict[str, float], first: Column, size: Column) -> Column:
    ends = [f(_position(q)) for q in quantiles.values() for f in (F.floor, F.ceil)]
    return F.filter(F.array_distinct(F.array(*ends)), lambda rank: (rank >= first) & (rank < first + size))


def _inside(rows: DataFrame, ranges: DataFrame, group: str, value: str) -> DataFrame:
    """The rows in ``ranges``, of which a group has a few that do not overlap."""
    above = F.coalesce(F.col(value) > F.col("_above"), F.lit(True))
    upto = F.coalesce(F.col(value) <= F.col("_upto"), F.lit(True))
    return join_by_key(rows, ranges, [group]).filter(above & upto)


def _narrowed(
    rows: DataFrame, edged: DataFrame, group: str, value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Ranges cut at their ``_edges``: those parts that hold a wanted rank, with their exact numbers of rows."""
    number = F.size(F.filter("_edges", lambda edge: F.col(value) > edge))
    parts = _inside(rows, edged, group, value).select(
        group, value, "_n", "_before", number.alias("_part"),
        # its ends go along: the rows between them are looked up by value
        F.coalesce(F.get("_edges", number - 1), F.col("_above")).alias("_above"),
        F.coalesce(F.get("_edges", number), F.col("_upto")).alias("_upto"),
    )
    preceding = Window.partitionBy(group, "_before").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        parts.groupBy(group, "_n", "_before", "_part", "_above", "_upto")
        .agg(F.count(F.lit(1)).alias("_size"), F.min(value).alias("_least"), F.max(value).alias("_most"))
        .withColumn("_start", F.col("_before") + F.coalesce(F.sum("_size").over(preceding), F.lit(0)))
        .filter(F.size(_ranks_within(quantiles, F.col("_start"), F.col("_size"))) > 0)
        .select(group, "_n", "_above", "_upto", F.col("_start").alias("_before"), "_size", "_least", "_most")
    )


def _edges(rows: DataFrame, ranges: DataFrame, group: str, value: str, accuracy: int) -> DataFrame:
    """Ranges with bounds to cut them at.

    The least value and the greatest are parted from the rest, however many rows they have, so that a frequent
    value is a range of its own after two rounds; all others are cut into parts of about as many rows.
    """
    below = F.when(F.col(value) < F.col("_most"), F.col(value))
    grid = [k / _PARTS for k in range(1, _PARTS)]
    return (
        _inside(rows, ranges, group, value).groupBy(group, *_RANGE)
        .agg(F.percentile_approx(below, grid, accuracy).alias("_grid"), F.max(below).alias("_next"), F.min(value).alias("_first"))
        .withColumn("_edges", F.array_sort(F.array_distinct(F.concat("_grid", F.array("_next", "_first")))))
        .drop("_grid", "_next", "_first")
    )


def _walked(
    rows: DataFrame, ranges: DataFrame, group: str, value: str, quantiles: dict[str, float]
) -> DataFrame:
    """The quantiles from the values of the ranges that hold their ranks."""
    smaller = Window.partitionBy(group, "_before").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1
    )
    hits = (
        _counted(rows, ranges, group, value)
        .withColumn("_first", F.col("_before") + F.coalesce(F.sum("_count").over(smaller), F.lit(0)))
        .withColumn("_rank", F.explode(_ranks_within(quantiles, F.col("_first"), F.col("_count"))))
    )

    def interpolated(q: float):
        at = _position(q)
        low = F.max(F.when(F.col("_rank") == F.floor(at), F.col(value)))
        high = F.max(F.when(F.col("_rank") == F.ceil(at), F.col(value)))
        part = F.max(at - F.floor(at))
        return low + (high - low) * part

    return hits.groupBy(group).agg(
        F.max("_n").alias("n"),
        *[interpolated(q).alias(name) for name, q in quantiles.items()],
    )


def _counted(rows: DataFrame, ranges: DataFrame, group: str, value: str) -> DataFrame:
    """The values in the ranges, each with its count: all that is shuffled to walk them."""
    return (
        _inside(rows, ranges.select(group, *_RANGE), group, value)
        .groupBy(group, "_n", "_before", value)
        .agg(F.count(F.lit(1)).alias("_count"))
    )
