"""Categories by rules that are a table: a substring index over distinct merchants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscore.config import CATEGORY_RULES, OTHER_CATEGORY
from spendscore.operators.skew import HOT_ROWS, heavy_keys, join_by_key, split_heavy

#: Signs of a run. A shorter substring is a run itself.
RUN = 3


def rules_table(spark, rules: Sequence[tuple[str, Sequence[str]]] = CATEGORY_RULES) -> DataFrame:
    """Rules of a short list, in match order, as a table: rule (a number), category, substring."""
    literals = [
        F.struct(F.lit(number).cast("long").alias("rule"), F.lit(category).alias("category"), F.lit(substring).alias("substring"))
        for number, (category, substrings) in enumerate(rules)
        for substring in substrings
    ]
    return spark.range(0, 1, 1, numPartitions=1).select(F.inline(F.array(*literals)))


def _runs(text: Column, size: Column | int) -> Column:
    """The distinct runs of ``size`` signs in ``text``."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array())
    return F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, size)))


def matched_rules(merchants: DataFrame, rules: DataFrame, merchant: str = "merchant") -> DataFrame:
    """Per merchant that a rule fits: ``merchant`` and the ``category`` of the first one by number.

    ``merchants`` has one row each. A rule is listed under that run of its substring which the fewest merchants
    have; it meets only the merchants that have this run, and ``contains`` decides. A rule with a run
    that no merchant has is gone at once. Rules of one number take the alphabetically first category.
    """
    rules = rules.filter("substring IS NOT NULL AND rule IS NOT NULL").select("rule", "category", "substring").distinct()
    name = F.col(merchant)
    sizes = F.transform(F.sequence(F.lit(1), F.lit(RUN)), lambda size: _runs(name, size))
    runs = merchants.filter(name.isNotNull()).select(merchant, F.explode(F.flatten(sizes)).alias("run"))
    frequency = runs.groupBy("run").agg(F.count(F.lit(1)).alias("merchants"))
    # An empty substring is in every name: of these rules only the first can count.
    empty = rules.filter("substring = ''").agg(F.min(F.struct("rule", "category")).alias("always"))
    listed = (
        rules.filter("substring <> ''")
        .withColumn("run", F.explode(_runs(F.col("substring"), F.least(F.length("substring"), F.lit(RUN)))))
        .join(frequency, "run", "left")
        .groupBy("rule", "category", "substring")
        .agg(F.min(F.struct(F.coalesce("merchants", F.lit(0)).alias("merchants"), "run")).alias("rare"))
        .filter("rare.merchants > 0").select("rule", "category", "substring", F.col("rare.run").alias("run"))
    )
    found = (
        runs.join(listed, "run").filter(F.contains(name, F.col("substring")))
        .groupBy(merchant).agg(F.min(F.struct("rule", "category")).alias("first"))
    )
    # One row at most, looked up by value.
    always = empty.select("always").scalar()
    first = F.least(F.col("first"), always)
    return (
        merchants.filter(name.isNotNull()).select(merchant).join(found, merchant, "left")
        .select(merchant, first["category"].alias("category")).filter("category IS NOT NULL")
    )


def categorize_by_rules(
    df: DataFrame,
    rules: DataFrame,
    *,
    merchant: str = "merchant",
    other: str = OTHER_CATEGORY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``category``: that of the first rule (by number) whose substring occurs in ``merchant``.

    ``rules`` is a table (rule, category, substring) of any length. Distinct merchants are matched once
    each; rows of the most frequent ones get their label by broadcast, the others by a join. Rows without a
    merchant, and such as no rule fits, get ``other``.
    """
    merchants = df.groupBy(merchant).agg(F.count(F.lit(1)).alias("_n")).select(merchant)
    labels = matched_rules(merchants, rules, merchant)
    heavy = heavy_keys(df, [merchant], hot_rows=hot_rows)
    hot, cold = split_heavy(df, heavy, [merchant])
    few = join_by_key(labels, heavy, [merchant])
    both = join_by_key(hot, few, [merchant], "left").unionByName(cold.join(labels, merchant, "left").select(*df.columns, "category"))
    return both.withColumn("category", F.coalesce("category", F.lit(other)))
