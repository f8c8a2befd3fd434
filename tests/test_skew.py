from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendscore.operators import skew
from spendscore.operators.quantiles import grouped_quantiles
from spendscore.operators.skew import expand_copies, heavy_keys, split_heavy


def test_heavy_keys_are_the_heaviest(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 5 + [2] * 3 + [3] * 2 + [None] * 4], "k int")
    heavy = lambda **kw: [r["k"] for r in heavy_keys(df, ["k"], **kw).collect()]
    assert sorted(heavy(hot_rows=2), key=str) == [1, 2, None]
    assert len(heavy(hot_rows=0)) == 4
    assert heavy(hot_rows=5) == []


def test_split_keeps_every_row_once(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 1, 2, None, None])], "k int, v int")
    heavy = heavy_keys(df, ["k"], hot_rows=1)
    hot, cold = split_heavy(df, heavy, ["k"])
    assert sorted(r["v"] for r in hot.collect()) == [0, 1, 2, 4, 5]
    assert [r["v"] for r in cold.collect()] == [3]
    assert hot.columns == cold.columns == ["k", "v"]


def test_expand_copies(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10), ("d", 11)], "k string, n long")
    counts = expand_copies(df, "n", block=10).groupBy("k").agg(F.count("*").alias("n"))
    assert dict(map(tuple, counts.collect())) == {"a": 1, "b": 25, "c": 10, "d": 11}


def test_large_groups_of_copies_are_spread_over_tasks(spark):
    df = spark.createDataFrame([("a", 100_000)], "k string, n long")
    spread = expand_copies(df, "n", block=1_000).groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in spread.collect()]
    assert sum(sizes) == 100_000 and max(sizes) < 50_000


def test_too_many_groups_are_not_broadcast(spark):
    df = spark.range(60).selectExpr("id % 20 AS g", "id AS v")
    assert grouped_quantiles(df, "g", "v", {"m": 0.5}, max_groups=20).count() == 20
    with pytest.raises(Exception, match="more than 19 values to broadcast"):
        grouped_quantiles(df, "g", "v", {"m": 0.5}, max_groups=19).collect()


def test_heavy_keys_fit_the_broadcast(spark, monkeypatch):
    """A small ``hot_rows`` lets no more keys pass than fit it: those with the most rows."""
    monkeypatch.setattr(skew, "MOST_HEAVY", 4)
    df = spark.createDataFrame([(k, float(k)) for k in range(1, 9) for _ in range(k // 2)], "k int, v double")  # 0 to 4 rows
    heavy = skew.heavy_keys(df, ["k"], hot_rows=0, total=F.sum("v"))
    assert sorted(heavy.collect()) == [(6, 18.0), (7, 21.0), (8, 32.0)]  # 3 rows twice, 4 rows once: with 2 rows they'd be 5
    assert sorted(r["k"] for r in skew.heavy_keys(df, ["k"], hot_rows=3).collect()) == [8]
