"""Nearest-example category of a merchant name by TF-IDF cosine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscore.config import CATEGORY_EXAMPLES, OTHER_CATEGORY
from spendscore.operators.skew import HOT_ROWS, heavy_keys, join_by_key, split_heavy

# Equal similarities may differ in their last bits; they count as equal here.
_TIE_DIGITS = 12


# Examples beyond which their token table is not broadcast.
MOST_EXAMPLES = 10_000


def words(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def char_trigrams(text: Column) -> Column:
    """All runs of three characters, white space runs taken as one blank."""
    flat = F.regexp_replace(F.lower(text), r"\s\s+", " ")
    starts = F.when(F.length(flat) >= 3, F.sequence(F.lit(1), F.length(flat) - 2))
    return F.transform(starts, lambda start: F.substring(flat, start, F.lit(3)))


_TOKENIZERS = {"word": words, "char3": char_trigrams}


def _weighted_examples(
    spark, examples: Sequence[tuple[str, Sequence[str]]], tokenize
) -> DataFrame:
    """Token -> (idf, the examples that have it with their unit-length weight)."""
    flat = [(label, name) for label, names in examples for name in names]
    literals = [
        F.struct(
            F.lit(index).alias("example"), F.lit(label).alias("label"), F.lit(name).alias("name")
        )
        for index, (label, name) in enumerate(flat)
    ]
    # one partition: the token table of a short list needs no shuffle
    known = spark.range(0, 1, 1, numPartitions=1).select(F.inline(F.array(*literals)))
    counts = (
        known.select("example", "label", F.explode(tokenize(F.col("name"))).alias("token"))
        .groupBy("example", "label", "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    idf = F.log((1 + len(flat)) / (1 + F.count(F.lit(1)).over(Window.partitionBy("token")))) + 1
    weight = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("example")))
    return (
        counts.withColumn("idf", idf)
        .withColumn("weight", weight / length)
        .groupBy("token", "idf")
        .agg(F.collect_list(F.struct("example", "label", "weight")).alias("postings"))
    )


def nearest_category(
    names: DataFrame,
    examples: Sequence[tuple[str, Sequence[str]]] = CATEGORY_EXAMPLES,
    *,
    tokenizer: str = "word",
    k: int = 1,
    min_similarity: float | None = None,
    merchant: str = "merchant",
    other: str = OTHER_CATEGORY,
) -> DataFrame:
    """Per distinct merchant: its rows, nearest category and similarity.

    ``examples`` is a short list given by the caller, of ``MOST_EXAMPLES`` at most, so its token table is
    broadcast; merchants are counted first and matched once each. Ties go to
    the earlier example. A name without a known token is equally far from all
    examples and gets the first one's label with similarity 0, unless
    ``min_similarity`` turns such names into ``other``. A NULL name has no
    label. With ``k > 1`` there are up to ``k`` ranked rows per merchant.
    """
    if sum(len(group) for _, group in examples) > MOST_EXAMPLES:
        raise ValueError(f"more than {MOST_EXAMPLES} examples are no list to broadcast")
    tokenize = _TOKENIZERS[tokenizer]
    vocabulary = _weighted_examples(names.sparkSession, examples, tokenize)
    distinct = names.groupBy(merchant).agg(F.count(F.lit(1)).alias("n_rows"))

    tokens = (
        distinct.select(merchant, F.explode(tokenize(F.col(merchant))).alias("token"))
        .groupBy(merchant, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(F.broadcast(vocabulary), "token")
        .withColumn("weight", F.col("tf") * F.col("idf"))
        .withColumn(
            "length",
            F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(merchant))),
        )
    )
    similar = (
        tokens.select(
            merchant, "length", F.col("weight").alias("own"), F.inline("postings")
        )
        .groupBy(merchant, "example", "label")
        .agg(
            F.round(F.sum(F.col("own") * F.col("weight") / F.col("length")), _TIE_DIGITS)
            .alias("similarity")
        )
    )
    # at most one row per example and merchant, whatever the table holds
    ranked = (
        similar.withColumn(
            "rank",
            F.row_number().over(
                Window.partitionBy(merchant).orderBy(F.desc("similarity"), "example")
            ),
        )
        .filter(F.col("rank") <= k)
        .select(merchant, "rank", F.col("label").alias("category"), "similarity")
    )

    first_label = F.lit(examples[0][0])
    matched = distinct.join(ranked, merchant, "left").select(
        merchant,
        "n_rows",
        F.coalesce("rank", F.lit(1)).alias("rank"),
        F.when(F.col(merchant).isNotNull(), F.coalesce("category", first_label)).alias("category"),
        F.when(F.col(merchant).isNotNull(), F.coalesce("similarity", F.lit(0.0))).alias(
            "similarity"
        ),
    )
    if min_similarity is not None:
        far = F.col("similarity") < min_similarity
        matched = matched.withColumn(
            "category", F.when(far, F.lit(other)).otherwise(F.col("category"))
        )
    return matched if k > 1 else matched.drop("rank")


def label_nearest(
    df: DataFrame,
    examples: Sequence[tuple[str, Sequence[str]]] = CATEGORY_EXAMPLES,
    *,
    tokenizer: str = "word",
    min_similarity: float | None = None,
    merchant: str = "merchant",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row of ``df`` with the nearest ``category`` of its merchant.

    Rows of the most frequent merchants get their label by broadcast; only the
    others are shuffled to meet theirs.
    """
    matched = nearest_category(
        df, examples, tokenizer=tokenizer, min_similarity=min_similarity, merchant=merchant
    ).select(merchant, "category")
    rows = df.drop("category")
    heavy = heavy_keys(df, [merchant], hot_rows=hot_rows)
    hot, cold = split_heavy(rows, heavy, [merchant])
    labels = join_by_key(matched, heavy, [merchant])
    return join_by_key(hot, labels, [merchant]).unionByName(
        cold.join(matched, merchant, "left").select(*rows.columns, "category")
    )
