"""The data behind the seven score charts, as queries on the score table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscore.functions.expressions import pearson
from spendscore.operators.quantiles import grouped_quantiles

# The columns of the correlation chart.
CORRELATED = ("total_spend", "discretionary_ratio", "salary_to_spend_ratio", "sds_score")

WHISKER = 1.5  # box plot fences, in interquartile ranges


def score_histogram(score: DataFrame) -> DataFrame:
    return (
        score.filter(F.col("sds_score").isNotNull())
        .groupBy("sds_score")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("sds_score")
    )


def ratio_counts(
    score: DataFrame, column: str = "discretionary_ratio", digits: int | None = None
) -> DataFrame:
    """Customers per distinct ratio, most frequent first."""
    ratio = F.col(column) if digits is None else F.round(column, digits)
    return (
        score.filter(F.col(column).isNotNull())
        .groupBy(ratio.alias(column))
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), column)
    )


def ratio_buckets(
    score: DataFrame,
    edges: Sequence[float] = tuple(i / 10 for i in range(11)),
    column: str = "discretionary_ratio",
) -> DataFrame:
    """Customers per interval ``[edge, next edge)``; bucket 0 lies below all edges."""
    bucket = sum((F.col(column) >= edge).cast("int") for edge in edges)
    return (
        score.filter(F.col(column).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .withColumn("low", F.get(F.lit(list(map(float, edges))), F.col("bucket") - 1))
        .withColumn("high", F.get(F.lit(list(map(float, edges))), F.col("bucket")))
        .orderBy("bucket")
    )


def _fences(score: DataFrame, **options) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    return grouped_quantiles(
        score, "sds_score", "total_spend", {"q1": 0.25, "median": 0.5, "q3": 0.75}, **options
    ).withColumns(
        {
            "fence_low": F.col("q1") - WHISKER * spread,
            "fence_high": F.col("q3") + WHISKER * spread,
        }
    )


def _with_fences(score: DataFrame, **options) -> DataFrame:
    # one row per score, of which the clamp allows 901
    return score.filter(F.col("total_spend").isNotNull()).join(
        F.broadcast(_fences(score, **options)), "sds_score"
    )


_INSIDE = "total_spend BETWEEN fence_low AND fence_high"


def spend_boxstats(score: DataFrame, **options) -> DataFrame:
    """Box plot of the spend per score: quartiles, whiskers, outlier count.

    ``options`` are those of ``grouped_quantiles``, ``max_rows`` among them.
    """
    inside, spend = F.expr(_INSIDE), F.col("total_spend")
    return (
        _with_fences(score, **options)
        .groupBy("sds_score", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, spend)).alias("lo"),
            F.max(F.when(inside, spend)).alias("hi"),
            F.count_if(~inside).alias("n_out"),
        )
        .orderBy("sds_score")
    )


def spend_outliers(score: DataFrame) -> DataFrame:
    """The customers a box plot draws beyond its whiskers."""
    return (
        _with_fences(score)
        .filter(~F.expr(_INSIDE))
        .select("sds_score", "customer_id", "total_spend")
    )


def scatter_points(
    score: DataFrame, fraction: float | None = None, seed: int | None = None
) -> DataFrame:
    """Salary ratio against score; ``fraction`` draws a sample for plotting."""
    points = score.select("salary_to_spend_ratio", "sds_score", "discretionary_ratio")
    return points if fraction is None else points.sample(fraction, seed)


def spend_share(
    score: DataFrame, by: str = "bucket", threshold: float = 0.5
) -> DataFrame:
    """Spend and its percentage by kind of customer.

    ``by="bucket"`` parts customers at ``threshold``; ``by="ratio"`` makes one
    slice per distinct ratio, of which there can be as many as customers.
    """
    ratio = F.col("discretionary_ratio")
    if by == "bucket":
        kind = F.when(ratio > threshold, "Discretionary").otherwise("Non-Discretionary")
        slices = score.groupBy(kind.alias("kind"))
    elif by == "ratio":
        slices = score.groupBy("discretionary_ratio")
    else:
        raise ValueError(f"by must be 'bucket' or 'ratio', not {by!r}")
    spent = slices.agg(F.sum("total_spend").alias("total_spend"))
    # summed from the slices, whose shuffle both uses share
    total = spent.agg(F.sum("total_spend")).scalar()
    return spent.withColumn("percent", F.try_divide(F.col("total_spend") * 100, total))


def top_spenders(score: DataFrame, k: int = 5) -> DataFrame:
    return (
        score.select("customer_id", "total_spend", "sds_score")
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(k)
    )


def correlations(score: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson's r of every pair of ``columns``, from one pass over the rows."""
    numbers = score.select(*[F.col(name).cast("double").alias(name) for name in columns])
    pairs = list(combinations(columns, 2))
    wide = numbers.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r"))
        for a, b in pairs
    ]
    return wide.select(F.inline(F.array(*rows)))
