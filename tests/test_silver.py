from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendscore.operators import silver, skew, windows


def test_single_day_has_no_volatility(debit):
    df = debit((1, "2024-01-01", 5.0, "Rent"), (1, "2024-01-01", 7.0, "Rent"))
    assert silver.volatility(df).first()["spend_volatility"] is None


def test_volatility_ignores_days_without_spend(debit):
    df = debit((1, "2024-01-01", 5.0, "Rent"), (1, "2024-01-01", 7.0, "Rent"),
               (1, "2024-03-01", 2.0, "Rent"))
    assert silver.volatility(df).first()["spend_volatility"] == pytest.approx(
        statistics.stdev([12.0, 2.0])
    )


def test_unknown_merchant_is_a_group(debit):
    df = debit((1, "2024-01-01", 5.0, "Other", None), (1, "2024-02-01", 5.0, "Other", None),
               (1, "2024-02-01", 5.0, "Other", "a"))
    assert [tuple(r) for r in silver.recurring_merchants(df).collect()] == [(1, "Other", None, 2)]
    assert silver.recurring_merchants(df, min_count=1).count() == 2


def test_month_labels():
    assert silver.month_labels(date(2023, 11, 5), date(2024, 2, 1)) == [
        "2023_Nov", "2023_Dec", "2024_Jan", "2024_Feb",
    ]


def test_pivot(debit):
    df = debit((1, "2024-01-01", 5.0, "Rent", "b"), (1, "2024-01-09", 7.0, "Rent", "a"),
               (2, "2024-02-09", 1.0, "Rent", "a"), (3, "2020-02-09", 1.0, "Rent", "a"))
    monthly = silver.monthly_spend(df)
    months = ["2024_Jan", "2024_Feb"]

    def rows(agg):
        return sorted(tuple(r) for r in silver.pivot_months(monthly, months, agg).collect())

    assert rows("sum")[:2] == [(1, 12.0, None), (2, None, 1.0)]
    assert rows("first")[:2] == [(1, 7.0, None), (2, None, 1.0)]
    assert len(rows("sum")) == 3  # a customer without spend in these months stays
    free = silver.pivot_months(monthly)
    assert free.columns == ["customer_id", "2020_Feb", "2024_Feb", "2024_Jan"]  # sorted as text
    with pytest.raises(ValueError):
        silver.pivot_months(monthly, months, "last")


def test_rolling_months_skips_missing_months(debit):
    df = debit((1, "2023-11-03", 1.0, "Rent"), (1, "2024-01-03", 2.0, "Rent"),
               (1, "2024-01-13", 4.0, "Rent"), (1, "2024-04-13", 8.0, "Rent"))
    rows = windows.rolling_months(df).orderBy("year", "month").collect()
    assert [(r["year"], r["month"], r["rolling_spend"]) for r in rows] == [
        (2023, 11, 1.0), (2024, 1, 7.0), (2024, 4, 8.0),
    ]


def test_profile_and_its_fanout(debit):
    df = debit((1, "2024-01-01", 5.0, "Rent", "a"), (1, "2024-01-02", 6.0, "Rent", "a"),
               (1, "2024-01-03", 7.0, "Other", "b"), (2, "2024-01-03", 7.0, "Other", "b"),
               (None, "2024-01-03", 7.0, "Other", "b"), (None, "2024-01-04", 9.0, "Other", "b"))
    profile = {r["customer_id"]: tuple(r)[1:] for r in silver.spend_profile(df).collect()}
    assert profile == {1: (18.0, 1.0, 1), 2: (7.0, None, 0), None: (16.0, None, 0)}
    # by hand: 3 * 3 * 1 for customer 1, 1 for customer 2, two unmatched rows
    assert tuple(silver.profile_fanout_size(df).first()) == (6, 12)


def brute_rolling(rows, n):
    """Rows (customer, category, date, amount, tie) with the sum over the last n."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0], row[1]].append(row)
    result = []
    for group in groups.values():
        group.sort(key=lambda r: (r[2], r[3], r[4]))
        for i, row in enumerate(group):
            result.append((*row, round(sum(r[3] for r in group[max(0, i - n + 1) : i + 1]), 2)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("hot_rows", [10**9, 40, 0])
@pytest.mark.parametrize("n", [1, 3, 4])
def test_rolling_rows_against_brute_force(spark, debit, hot_rows, n):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        customer = rng.choice([None, 1, 1, 1, 2, 3])
        day = f"2024-01-{rng.randint(1, 4):02d}"
        rows.append((customer, day, float(rng.randint(1, 6)), rng.choice(["Rent", "Other"]),
                     rng.choice("ab")))
    rows += [(1, "2024-01-02", 3.0, "Rent", "a")] * 150  # a large group of copies
    expected = brute_rolling([(r[0], r[3], r[1], r[2], r[4]) for r in rows], n)
    got = windows.rolling_rows(debit(*rows), n, hot_rows=hot_rows).collect()
    assert sorted(
        (
            (r["customer_id"], r["category"], str(r["txn_date"]), r["amount"], r["merchant"],
             round(r["three_month_category_spend"], 2))
            for r in got
        ),
        key=repr,
    ) == expected


def test_chunks_keep_the_order_of_any_number(spark, debit):
    numbers = [0.0, -0.0, -1.5, -1e-9, 1e-9, 1e9, -1e9, 1e300, -1e300, float("inf"), float("nan"),
               0.01, 0.02, 3.0, 3.05, None]
    df = debit(*[(1, "2024-01-01", number, "Rent") for number in numbers])
    ordered = [
        (row["amount"], row["slice"])
        for row in df.select("amount", windows._slice_of(F.col("amount")).alias("slice"))
        .orderBy("amount").collect()
    ]
    known = [cut for _, cut in ordered[1:]]
    assert ordered[0] == (None, None) and known == sorted(known)
    assert len(set(known)) > 8


def test_heavy_groups_with_refunds(spark, debit):
    rng = random.Random(9)
    df = debit(*[(1, f"2024-01-0{rng.randint(1, 3)}", rng.choice([-5.0, -0.25, 0.0, 0.25, 80.0]), "Rent")
                 for _ in range(200)])
    left, right = windows.rolling_rows(df, 3), windows.rolling_rows(df, 3, hot_rows=0)
    assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


@pytest.mark.parametrize("n", [1, 3, 4])
def test_both_ways_give_the_same_bits(spark, debit, n):
    rng = random.Random(12)
    amounts = [0.1, 0.2, 0.3, 1 / 3, 1e9 + 0.1, None, float("nan"), float("inf"), -0.7]
    df = debit(*[(rng.choice([None, 1, 2]), f"2024-01-0{rng.randint(1, 9)}", rng.choice(amounts) if k % 2 else rng.random() * 90, "Rent",
                  rng.choice("abc")) for k in range(600)], *[(1, "2024-01-02", 0.1, "Rent", "a")] * 40)
    bits = lambda hot_rows: sorted(map(repr, windows.rolling_rows(df, n, hot_rows=hot_rows).collect()))
    assert bits(10**9) == bits(150) == bits(0)


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_rolling_rows_skips_unknown_amounts(debit, hot_rows):
    df = debit((1, "2024-01-01", None, "Rent"), (1, "2024-01-02", None, "Rent"),
               (1, "2024-01-03", 4.0, "Rent"), (1, "2024-01-04", 5.0, "Rent"),
               (1, None, 9.0, "Rent"))
    rows = windows.rolling_rows(df, 3, hot_rows=hot_rows).collect()
    got = {str(r["txn_date"]): r["three_month_category_spend"] for r in rows}
    assert got == {
        "None": 9.0, "2024-01-01": 9.0, "2024-01-02": 9.0, "2024-01-03": 4.0, "2024-01-04": 9.0,
    }


@pytest.mark.parametrize("hot_rows", [10**9, 1, 0])
def test_total_spend_with_and_without_heavy_keys(debit, hot_rows):
    df = debit((1, "2024-01-01", 1.0, "Rent"), (1, "2024-01-01", 2.0, "Rent"),
               (2, "2024-01-01", 4.0, "Rent"), (None, "2024-01-01", 8.0, "Rent"),
               (None, "2024-01-02", 16.0, "Rent"))
    got = windows.with_total_spend(df, hot_rows=hot_rows)
    assert got.columns == [*df.columns, "total_spend"]
    assert sorted((r["amount"], r["total_spend"]) for r in got.collect()) == [
        (1.0, 3.0), (2.0, 3.0), (4.0, 4.0), (8.0, 24.0), (16.0, 24.0),
    ]


def test_order_of_input_rows_changes_nothing(debit):
    rng = random.Random(3)
    rows = [(rng.randint(0, 3), f"2024-0{rng.randint(1, 4)}-05", float(rng.randint(1, 99)), "Rent",
             rng.choice("abc")) for _ in range(80)]
    shuffled = rng.sample(rows, len(rows))
    for operator in (windows.rolling_rows, windows.rolling_months, silver.spend_profile):
        left, right = operator(debit(*rows)), operator(debit(*shuffled))
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(windows, "_LEAST_CHUNK", 6)


@pytest.mark.parametrize("n", [1, 3, 4])
def test_points_and_buckets_give_the_same_bits(spark, debit, small_chunks, n):
    """Rows of one customer, day and price in buckets, beside others of the same slice."""
    rng = random.Random(21)
    prices = [5.0, 5.0, 5.0, 5.0000001, 4.9999999, 0.0, 0.0, None, None, float("nan"), 70.1, 70.1]
    rows = [(rng.choice([None, 1, 1]), rng.choice(["2024-01-01", "2024-01-02", None]), rng.choice(prices), "Rent", f"shop {rng.randint(1, 200)}")
            for _ in range(900)]
    df = debit(*rows, *[(1, "2024-01-01", 5.0, "Rent", "shop 7")] * 30)
    bits = lambda hot_rows: sorted(map(repr, windows.rolling_rows(df, n, hot_rows=hot_rows).collect()))
    assert bits(10**9) == bits(0)
    chunks = windows._chunked(df, ["customer_id"], ("txn_date", "amount"), ["merchant"], 0).groupBy("_chunk").count().collect()
    assert len(chunks) > 60 and max(r["count"] for r in chunks) < 60
    assert any(r["_chunk"]["_bucket"] > 0 for r in chunks) and any(r["_chunk"]["_part"] > 1 for r in chunks)


def test_a_few_rows_a_chunk_reach_the_next(spark, debit, small_chunks):
    """Carried values pass chunks that are shorter than the window."""
    df = debit(*[(1, f"2024-01-{day:02d}", float(k), "Rent") for day in range(1, 29) for k in (1, 40)[: 1 + day % 2]])
    for n in (2, 5, 9):
        left, right = windows.rolling_rows(df, n), windows.rolling_rows(df, n, hot_rows=0)
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0


def test_one_customer_day_and_price_is_dealt_to_many_tasks(spark):
    """400,000 merchants: no task of the windows gets more than 5 percent of the rows."""
    rows = 400_000
    df = spark.range(rows).selectExpr(
        "1 AS customer_id", "date'2024-01-01' AS txn_date", "9.99D AS amount", "concat('shop ', id) AS merchant", "'Rent' AS category")
    settings = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {name: spark.conf.get(name) for name in settings}
    for name, setting in settings.items():
        spark.conf.set(name, setting)
    try:
        chunk = windows._chunked(df, ["customer_id", "category"], ("txn_date", "amount"), ["merchant"], 0)
        tasks = chunk.repartition("_chunk").groupBy(F.spark_partition_id().alias("task")).count().collect()
        got = windows.rolling_rows(df, 3, hot_rows=0)
        summed = got.groupBy(F.round("three_month_category_spend", 2).alias("s")).count().orderBy("s").collect()
    finally:
        for name, setting in kept.items():
            spark.conf.set(name, setting)
    assert max(r["count"] for r in tasks) <= 0.05 * rows
    assert [tuple(r) for r in summed] == [(9.99, 1), (19.98, 1), (29.97, rows - 2)]


@pytest.mark.parametrize("hot_rows", [10**9, 40, 0])
def test_both_windows_at_once(spark, debit, hot_rows):
    rng = random.Random(8)
    df = debit(*[(rng.choice([None, 1, 1, 2, 3]), f"2024-01-0{rng.randint(1, 9)}", rng.choice([0.5, 2.25, 8.0, None]), rng.choice(["Rent", "Misc"]),
                  rng.choice("abc")) for _ in range(300)])
    both = windows.spend_windows(df, hot_rows=hot_rows)
    assert both.columns == [*df.columns, "total_spend", "three_month_category_spend"] or both.columns == [
        *df.columns, "three_month_category_spend", "total_spend"]
    apart = windows.rolling_rows(windows.with_total_spend(df))
    # equal rows but for their order: the total is among the ties there
    names = [*df.columns, "total_spend"]
    assert both.select(names).exceptAll(apart.select(names)).count() == 0
    alone = windows.rolling_rows(df)
    names = alone.columns
    assert both.select(names).exceptAll(alone).count() == alone.exceptAll(both.select(names)).count() == 0


def test_both_windows_need_one_shuffle_of_the_rows(spark, debit):
    df = debit((1, "2024-01-01", 1.0, "Rent"), (2, "2024-01-01", 2.0, "Food"))
    summed = df.withColumn("total_spend", F.sum("amount").over(windows.Window.partitionBy("customer_id")))
    plan = windows._rolling(summed, 3, ("customer_id", "category"), ("txn_date", "amount"), "amount", "rolling", ties=["merchant"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    whole = windows.spend_windows(df)._jdf.queryExecution().executedPlan().toString()
    rows_of_customers = [line for line in whole.splitlines() if "Exchange hashpartitioning(customer_id" in line and "_rows" not in line]
    windowed = [line for line in whole.splitlines() if "Window [" in line]
    assert len(windowed) >= 2 and rows_of_customers


def test_rounded_totals_are_the_same_both_ways(spark, debit):
    rng = random.Random(2)
    df = debit(*[(1, "2024-01-01", rng.random() * 1e6, "Rent") for _ in range(500)])
    totals = {r["total_spend"] for hot_rows in (10**9, 0) for r in windows.with_total_spend(df, hot_rows=hot_rows, digits=2).collect()}
    assert len(totals) == 1


@pytest.mark.parametrize("operator", [windows.rolling_rows, windows.spend_windows])
def test_groups_that_fit_a_chunk_are_not_cut(debit, operator):
    """Heavy groups of a few rows: one window, no ends of chunks to carry."""
    df = debit(*[(k % 3, f"2024-01-{k % 28 + 1:02d}", k / 4, "Rent") for k in range(90)])
    rows = operator(df, 3, hot_rows=0)
    rows._jdf.queryExecution().executedPlan().execute().count()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "_carry" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("n", [1, 3])
def test_groups_in_one_chunk_beside_cut_ones(debit, small_chunks, monkeypatch, n):
    """Some groups are plain, as too many are heavy, some one chunk, some cut by days and within days: the bits are equal."""
    monkeypatch.setattr(skew, "MOST_HEAVY", 5)
    rng = random.Random(5)
    df = debit(*[(rng.choice([None, 1, 1, 1, 1, *range(2, 20)]), rng.choice(["2024-01-01", "2024-01-02", None]),
                  rng.choice([0.1, 1 / 3, None, 8.0, -0.7]), rng.choice(["Rent", "Rent", "Misc", None]), f"shop {rng.randint(1, 40)}")
                 for _ in range(500)], *[(1, "2024-01-02", 0.1, "Rent", "shop 1")] * 20)
    for operator in (windows.rolling_rows, windows.spend_windows):
        bits = [sorted(map(repr, operator(df, n, hot_rows=hot).select("customer_id", "category", "txn_date", "amount", "merchant",
                                                                     "three_month_category_spend").collect())) for hot in (10**9, 3, 0)]
        assert bits[0] == bits[1] == bits[2] and len(bits[0]) == 520
