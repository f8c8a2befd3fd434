"""Sources mixed to target weights by temperature, on built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendscore.llm.common import removed, unused, written_at

#: What separates words, for counting tokens.
BLANKS = " \t\n\x0b\x0c\r"
#: The exponent is found to 2^-24, four halvings in one job.
ROUNDS, CELLS = 6, 16
#: Leading hexadecimal digits of a place that make a bucket: running sums go over the 4096 buckets
#: of a source first, over those of the bucket that holds the end next, and so on while it has more places than this. A bucket
#: is never a whole place (32 digits), which would not be below itself.
DIGITS, BUCKET_PLACES, MOST_DIGITS = 3, 1_000_000, 31
EPSILON = 1e-6


def n_words(text: Column) -> Column:
    own = F.trim(text, F.lit(BLANKS))
    return F.when(F.length(own) > 0, F.size(F.split(own, f"[{BLANKS}]++"))).otherwise(0).cast("long")


def place(doc_id: Column, block: Column) -> Column:
    """Where a document stands in a block's permutation."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), block.cast("string")).cast("binary"))


def exponent(shares: DataFrame, entropy: float, repeats: float, budget: float) -> float:
    """The largest exponent up to 1 at which the weights of ``shares`` (one ``p`` a source) have
    the entropy, or the least that keeps the repetition limit if that is larger.

    ``entropy`` is a share of the largest possible; ``budget`` is the tokens to draw over all tokens. Both conditions are monotone in the exponent,
    so each is bisected.
    """
    n = shares.count()
    if n < 2:
        return 1.0

    def state(a: float) -> list[Column]:
        power, log = F.pow("p", F.lit(a)), F.log("p")
        z = F.sum(power)
        return [F.log(z) - a * F.sum(power * log) / z, F.max(F.pow("p", F.lit(a - 1))) * budget / z]

    goal = entropy * F.log(F.lit(n))

    def bisected(met) -> float:
        """The least exponent of [0, 1] from which on ``met`` holds (1 if it never does)."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / CELLS for k in range(CELLS + 1)]
            row = shares.agg(*[met(*state(a)).alias(f"m{k}") for k, a in enumerate(grid)]).first()
            first = next((k for k in range(1, CELLS) if row[f"m{k}"]), CELLS)
            low, high = grid[first - 1], grid[first]
        return high

    if shares.agg((state(1.0)[0] >= goal).alias("even")).first()["even"]:
        wanted = 1.0
    else:
        wanted = bisected(lambda h, _: h < goal)
    allowed = bisected(lambda _, most: most <= F.lit(repeats + EPSILON))
    if shares.agg((state(0.0)[1] <= F.lit(repeats + EPSILON)).alias("ok")).first()["ok"]:
        allowed = 0.0
    return round(max(wanted, allowed), 6)


def mixed_sources(
    docs: DataFrame,
    entropy: float = 0.97,
    repeats: float = 4.0,
    budget: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` drawn so that the sources' tokens come near their target weights.

    The weight of a source is its share of the tokens to an exponent, normalised. The
    exponent is as near to 1 as reaches ``entropy`` (as a share of that of equal weights) and leaves
    no source repeated more than ``repeats`` times; the limit goes first. A source's tokens, its weight times
    ``budget`` times all tokens, are drawn in blocks: each block is one permutation of
    the whole source, and the last one ends where the next document would go over.

    A row per document and block: all columns, with ``n_tokens``, ``block`` (from 0) and ``place`` (the
    order within the block) added, replacing columns of such names.

    * Rows without words (NULL and blank texts) are never drawn. A NULL source is a source.
    * Repeated rows are drawn together; rows without id share one place.
    * One source, or none with words, is drawn ``budget`` times over.
    * An empty table gives no rows.
    """
    if not (0 <= entropy <= 1 and repeats > 0 and budget > 0):
        raise ValueError("entropy is a share, repeats and budget are positive")
    spark = docs.sparkSession
    of_src, of_full, of_end = unused(docs, "__mix_src", "__mix_full", "__mix_end")
    sized, sized_at = written_at(
        docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("src"), n_words(F.col(text_col)).alias("tokens"))
        .where("tokens > 0"),
        "sized",
    )
    sums, sums_at = written_at(sized.groupBy("src").agg(F.sum("tokens").alias("all_tokens")), "sources")
    total = sums.agg(F.sum("all_tokens")).first()[0] or 1
    shares = sums.withColumn("p", F.col("all_tokens") / F.lit(total))
    a = exponent(shares, entropy, repeats, budget)
    norm = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    wanted = F.floor(F.pow("p", F.lit(a)) / F.lit(norm) * F.lit(float(budget) * total) + EPSILON)
    plan, plan_at = written_at(
        shares.select("src", "all_tokens", wanted.alias("wanted")).select(
            "src", F.floor(F.col("wanted") / F.col("all_tokens")).alias("full"),
            (F.col("wanted") % F.col("all_tokens")).alias("rest")),
        "plan",
    )
    same = lambda left, right: left["src"].eqNullSafe(right["src"])
    # Documents that share a place are drawn together.
    last, last_at = written_at(
        sized.join(plan, same(sized, plan)).select(plan["src"], "rest", "tokens", place(F.col("doc"), F.col("full")).alias("at"))
        .groupBy("src", "rest", "at").agg(F.sum("tokens").alias("tokens")),
        "last-blocks",
    )
    in_order = W.partitionBy("src").orderBy("bucket")
    inner, kept = last.withColumn("before", F.lit(0).cast("long")), [last_at]
    digits = DIGITS
    while True:
        # The bucket in which a source's tokens run out, and what comes before it.
        through = F.col("before") + F.sum("tokens").over(in_order)
        buckets = (
            inner.groupBy("src", "rest", "before", F.substring("at", 1, digits).alias("bucket")).agg(F.sum("tokens").alias("tokens"))
            .withColumn("through", through).where(F.col("through") > F.col("rest"))
            .groupBy("src").agg(F.min(F.struct("bucket", (F.col("through") - F.col("tokens")).alias("before"))).alias("cut"))
        )
        buckets, buckets_at = written_at(buckets.select("src", "cut.*"), "cut-buckets")
        inner = last.join(buckets.withColumnRenamed("bucket", "cut"), same(last, buckets)).where(F.col("cut") == F.substring("at", 1, digits)).select(
            last["src"], "rest", "before", "tokens", "at")
        kept.append(buckets_at)
        fullest = inner.groupBy("src").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if fullest <= BUCKET_PLACES or digits >= MOST_DIGITS:
            break
        digits = min(MOST_DIGITS, digits + DIGITS)
    taken = inner.withColumn("through", F.col("before") + F.sum("tokens").over(W.partitionBy("src").orderBy("at"))).where(
        F.col("through") <= F.col("rest"))
    ends, ends_at = written_at(taken.groupBy("src").agg(F.max("at").alias("end")), "ends")
    cuts, _ = written_at(
        plan.join(buckets, same(plan, buckets), "left").drop(buckets["src"]).alias("p")
        .join(ends.alias("e"), F.col("p.src").eqNullSafe(F.col("e.src")), "left")
        .select(F.col("p.src").alias(of_src), F.col("full").alias(of_full),
                # No place is below its own bucket's start, so the bucket alone bounds what comes before it.
                F.coalesce("end", "bucket").alias(of_end)),
        "draws",
    )
    removed(spark, sized_at, sums_at, plan_at, ends_at, *kept)
    drawn = (
        docs.drop("n_tokens", "block", "place")
        .withColumn("n_tokens", n_words(F.col(text_col))).where("n_tokens > 0")
        .join(cuts, F.col(source_col).eqNullSafe(F.col(of_src)))
    )
    more = F.coalesce(place(F.col(id_col), F.col(of_full)) <= F.col(of_end), F.lit(False)).cast("long")
    copies = F.col(of_full) + more
    return (
        drawn.withColumn("block", F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1))))
        .withColumn("place", place(F.col(id_col), F.col("block")))
        .drop(of_src, of_full, of_end)
    )
