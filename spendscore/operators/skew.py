"""Keeping a single heavy key out of a single task.

Grouped aggregates combine before the shuffle, so a heavy key costs them
nothing. Windows and row-to-group joins move every row of a key to one task.
For those, the heaviest keys are found first by a combining count, and their
rows take a way that is not bound to one task; all other keys take the plain
one. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is heavy from this many rows on; a task sorts that many with ease.
HOT_ROWS = 2_000_000
# So many heavy keys fit the broadcast, some 20 MB; with fewer rows a key than this, more might be found.
MOST_HEAVY, SMALL_ROWS = 500_000, 10_000


def heavy_keys(
    df: DataFrame, keys: Sequence[str], *, hot_rows: int = HOT_ROWS, **figures: Column
) -> DataFrame:
    """The keys of ``df`` with more than ``hot_rows`` rows, with ``figures``, further aggregates.

    There are fewer than rows / ``hot_rows`` of them, 500,000 of 10^12 rows. Where ``hot_rows`` is below ``SMALL_ROWS``
    more could pass: those with the most rows are taken, the others are plain keys.
    """
    # one struct: whatever a use reads of it, all share the shuffle
    named = [figure.alias(name) for name, figure in figures.items()]
    per_key = df.groupBy(*keys).agg(F.struct(F.count(F.lit(1)).alias("rows"), *named).alias("_of_key"))
    heavy = per_key.filter(F.col("_of_key")["rows"] > _least_rows(per_key, hot_rows))
    return heavy.select(*keys, *[F.col("_of_key")[name].alias(name) for name in figures])


def _least_rows(per_key: DataFrame, hot_rows: int) -> Column:
    """``hot_rows``, or the least number above it that no more than ``MOST_HEAVY`` keys exceed.

    Keys are counted by their rows. Numbers of rows that differ are few: less than the root of twice all rows.
    """
    if hot_rows >= SMALL_ROWS:
        return F.lit(hot_rows)
    by_rows = per_key.groupBy(F.col("_of_key")["rows"].alias("_rows")).agg(F.count(F.lit(1)).alias("_keys"))
    with_more = F.sum("_keys").over(Window.orderBy(F.desc("_rows")))
    beyond = by_rows.withColumn("_sum", with_more).filter(F.col("_sum") > MOST_HEAVY).agg(F.max("_rows")).scalar()
    return F.greatest(F.lit(hot_rows), F.coalesce(beyond, F.lit(0)))


def join_by_key(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``per_key``, which has few rows, by broadcast; NULL is a key like any other."""
    renamed = per_key.withColumnsRenamed({key: "_key_" + key for key in keys})
    same = [F.col(key).eqNullSafe(F.col("_key_" + key)) for key in keys]
    return df.join(F.broadcast(renamed), same, how).drop(*["_key_" + key for key in keys])


def few_groups(df: DataFrame, group: str, most: int) -> Column:
    """A condition that holds, or fails the job where ``group`` has more than ``most`` values.

    For tables with a row per group that are about to be broadcast.
    """
    found = df.agg(F.count_distinct(F.coalesce(F.col(group).cast("string"), F.lit("")))).scalar()
    message = F.concat(F.lit(f"{group} has more than {most} values to broadcast: "), found.cast("string"))
    return F.when(found > most, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def split_heavy(
    df: DataFrame, heavy: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split into the rows of the ``heavy`` keys and all others, without a shuffle.

    Both sides use the same broadcast. Where no key is heavy the first side is
    found empty at run time and nothing is read for it.
    """
    return join_by_key(df, heavy, keys), join_by_key(df, heavy, keys, "left_anti")


def expand_copies(df: DataFrame, copies: str, *, block: int = 100_000) -> DataFrame:
    """Repeat each row as often as its ``copies`` column says, and drop it.

    Up to ``block`` copies are made in place. Larger groups are first cut into
    blocks that are spread over all tasks.
    """
    kept = [name for name in df.columns if name != copies]
    few = df.filter(F.col(copies) <= block).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    )
    starts = F.sequence(F.lit(1).cast("long"), F.col(copies), F.lit(block).cast("long"))
    blocks = df.filter(F.col(copies) > block).withColumn("_start", F.explode(starts))
    last = F.least(F.col(copies), F.col("_start") + block - 1)
    # a fixed number of tasks: by their size alone the few block rows would be merged
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = blocks.repartition(tasks, "_start", F.xxhash64(*kept)).withColumn(
        "_copy", F.explode(F.sequence(F.col("_start"), last))
    )
    return few.select(*kept).unionByName(many.select(*kept))
