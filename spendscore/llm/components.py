"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscore.llm.common import removed, written_at


def connected(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """One ``root`` per ``node`` of the edges ``(a, b)``; equal roots mean connected.

    Each round points every node to the neighbour that comes first in an order
    drawn anew, and merges along the pointers. A drawn order shortens
    even long chains by a constant share per round, so the number of rounds grows with the
    logarithm of the longest chain. Rounds are written tables: no lineage
    builds up and nothing is collected. A hub with very many edges meets its
    one pointer in a join that adaptive execution can split.

    Loops, repeated edges and NULL ends are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    clean = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    current, current_at = written_at(clean, "edges")
    roots = roots_at = None
    for turn in range(most_rounds):
        if current.isEmpty():
            break
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda name: F.struct(F.xxhash64(F.lit(turn), name).alias("o"), F.col(name).alias("n"))
        pointers, pointers_at = written_at(
            both.groupBy("a").agg(F.min(order("b")).alias("first"))
            .select(F.col("a").alias("node"), F.least("first", order("a"))["n"].alias("to")),
            "pointers",
        )
        to = lambda end: pointers.select(F.col("node").alias(end), F.col("to").alias(f"to_{end}"))
        merged = (
            current.join(to("a"), "a").join(to("b"), "b").where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        )
        after, after_at = written_at(merged, "edges")
        if roots is None:
            roots, roots_at = pointers.withColumnRenamed("to", "root"), pointers_at
        else:
            moved = roots.join(
                pointers.select(F.col("node").alias("root"), "to"), "root", "left"
            ).select("node", F.coalesce("to", "root").alias("root"))
            kept, kept_at = written_at(moved, "roots")
            removed(spark, roots_at, pointers_at)
            roots, roots_at = kept, kept_at
        removed(spark, current_at)
        current, current_at = after, after_at
    else:
        raise RuntimeError(f"components not found after {most_rounds} rounds")
    if roots is None:
        return clean.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
