"""Nearest-example category for lists of examples that are tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendscore.config import CATEGORY_EXAMPLES, OTHER_CATEGORY
from spendscore.operators.text import _TIE_DIGITS, _TOKENIZERS

#: A token in more examples is frequent: its postings are cut into shards of as many.
POSTINGS = 1_000
#: What rounding may add to a bound.
_SLACK = 1e-9


def examples_table(spark, examples: Sequence[tuple[str, Sequence[str]]] = CATEGORY_EXAMPLES) -> DataFrame:
    """Examples of a short list, in order, as a table: example (a number), label, name."""
    flat = [(label, name) for label, names in examples for name in names]
    literals = [
        F.struct(F.lit(number).cast("long").alias("example"), F.lit(label).alias("label"), F.lit(name).alias("name"))
        for number, (label, name) in enumerate(flat)
    ]
    return spark.range(0, 1, 1, numPartitions=1).select(F.inline(F.array(*literals)))


def _norm(weights: Column) -> Column:
    return F.sqrt(F.aggregate(weights, F.lit(0.0), lambda total, token: total + token["own"] * token["own"]))


def _vectors(examples: DataFrame, tokenize) -> tuple[DataFrame, DataFrame]:
    """Per token its idf and number of examples, and per example and token the unit-length weight."""
    total = examples.agg(F.count(F.lit(1))).scalar()
    counts = (
        examples.select("example", "label", F.explode(tokenize(F.col("name"))).alias("token"))
        .groupBy("example", "label", "token").agg(F.count(F.lit(1)).alias("tf"))
    )
    vocabulary = counts.groupBy("token").agg(F.count(F.lit(1)).alias("found")).select(
        "token", "found", (F.log((1 + total) / (1 + F.col("found"))) + 1).alias("idf"))
    weight = F.col("tf") * F.col("idf")
    length = F.sqrt(F.sum(weight * weight).over(Window.partitionBy("example")))
    return vocabulary, counts.join(vocabulary, "token").select("example", "label", "token", "found", (weight / length).alias("weight"))


def _best(pairs: DataFrame) -> DataFrame:
    """Per vector the example of highest similarity; of equal ones the earliest."""
    return pairs.groupBy("vector").agg(
        F.max(F.struct("similarity", (-F.col("example")).alias("earliest"), "label")).alias("best"))


def nearest_of_many(
    names: DataFrame,
    examples: DataFrame,
    *,
    tokenizer: str = "word",
    min_similarity: float | None = None,
    merchant: str = "merchant",
    other: str = OTHER_CATEGORY,
    postings: int = POSTINGS,
) -> DataFrame:
    """The rows of ``nearest_category`` for ``examples(example, label, name)``, a table of any length.

    ``example`` is the place in the list, a number that no other has. Nothing is broadcast by force. Names are
    reduced to the distinct vectors of their known tokens. A vector first meets the examples with which it shares a token that at most
    ``postings`` have; their similarity is exact. An example with none of these tokens can't be nearer than the length of the vector's frequent part.
    Only where that isn't below the best so far do frequent tokens count: the rarest of them, as many as it takes for the rest to be
    shorter than the best. Their postings are cut into shards, so that no task gets all of a token's.
    """
    tokenize = _TOKENIZERS[tokenizer]
    vocabulary, weights = _vectors(examples, tokenize)
    distinct = names.groupBy(merchant).agg(F.count(F.lit(1)).alias("n_rows"))
    known = (
        distinct.select(merchant, F.explode(tokenize(F.col(merchant))).alias("token"))
        .groupBy(merchant, "token").agg(F.count(F.lit(1)).alias("tf")).join(vocabulary, "token")
        .select(merchant, F.struct("found", "token", (F.col("tf") * F.col("idf")).alias("own")).alias("t"))
        .groupBy(merchant).agg(F.sort_array(F.collect_list("t")).alias("vector"))
    )
    # Tokens in the order of how many examples have them, weights to unit length.
    vectors = known.select("vector").distinct().withColumn("length", _norm(F.col("vector"))).withColumn(
        "unit", F.transform("vector", lambda t: t.withField("own", t["own"] / F.col("length"))))
    of_vector = F.map_from_arrays(F.transform("unit", lambda t: t["token"]), F.transform("unit", lambda t: t["own"]))
    whole = weights.groupBy("example", "label").agg(F.collect_list(F.struct("token", "weight")).alias("tokens"))

    def similar(pairs: DataFrame) -> DataFrame:
        """Exact similarities of candidate pairs: whole vector by whole example."""
        dot = F.aggregate("tokens", F.lit(0.0), lambda total, t: total + F.coalesce(F.col("map")[t["token"]], F.lit(0.0)) * t["weight"])
        return (pairs.join(whole, "example").join(vectors.select("vector", of_vector.alias("map")), "vector")
                .select("vector", "example", "label", F.round(dot, _TIE_DIGITS).alias("similarity")))

    tokens = vectors.select("vector", F.explode("unit").alias("t")).select("vector", "t.*")
    rare = tokens.filter(F.col("found") <= postings).join(weights.select("token", "example"), "token").select("vector", "example").distinct()
    first = _best(similar(rare))

    # The length of what is left from each token on, over frequent ones: tokens count while it isn't below the best.
    frequent = F.filter("unit", lambda t: t["found"] > postings)
    left = vectors.join(first, "vector", "left").select(
        "vector", frequent.alias("frequent"), F.coalesce(F.col("best.similarity"), F.lit(0.0)).alias("least"))
    needed = F.filter(
        F.transform("frequent", lambda t, i: F.struct(
            t["token"].alias("token"), t["found"].alias("found"),
            _norm(F.slice("frequent", i + 1, F.size("frequent"))).alias("rest"))),
        lambda t: t["rest"] + F.lit(_SLACK) >= F.col("least"))
    shards = F.ceil(F.col("found") / postings).cast("int")
    asked = (
        left.select("vector", F.explode(needed).alias("t")).select("vector", "t.token", "t.found")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1)))
    )
    sharded = weights.filter(F.col("found") > postings).select("token", "example", F.pmod(F.xxhash64("example"), shards).cast("int").alias("shard"))
    more = asked.join(sharded, ["token", "shard"]).select("vector", "example").distinct()
    both = first.select("vector", "best").unionByName(_best(similar(more))).groupBy("vector").agg(F.max("best").alias("best"))

    ranked = known.join(both, "vector").select(merchant, F.col("best.label").alias("category"), F.col("best.similarity").alias("similarity"))
    first_label = examples.agg(F.min_by("label", "example")).scalar()
    is_name = F.col(merchant).isNotNull()
    matched = distinct.join(ranked, merchant, "left").select(
        merchant, "n_rows",
        F.when(is_name, F.coalesce("category", first_label)).alias("category"),
        F.when(is_name, F.coalesce("similarity", F.lit(0.0))).alias("similarity"))
    if min_similarity is not None:
        far = F.col("similarity") < min_similarity
        matched = matched.withColumn("category", F.when(far, F.lit(other)).otherwise(F.col("category")))
    return matched
