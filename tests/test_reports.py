from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendscore.operators import reports
from spendscore.operators.quantiles import grouped_quantiles

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


@pytest.mark.parametrize("accuracy", [10_000, 2])
@pytest.mark.parametrize("margin", [0.002, 0.0])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy, margin):
    rng = random.Random(1)
    values = {
        1: [rng.gauss(0, 100) for _ in range(3000)],
        2: [5.0] * 900 + [rng.uniform(0, 10) for _ in range(400)],  # one hot value
        3: [1.0],
        4: [1.0, 2.0],
    }
    df = spark.createDataFrame(
        [(g, v) for g, vs in values.items() for v in vs] + [(4, None)], "g int, v double"
    )
    got = grouped_quantiles(df, "g", "v", QUARTILES, accuracy=accuracy, margin=margin).collect()
    assert len(got) == 4
    for row in got:
        group = values[row["g"]]
        assert row["n"] == len(group)
        for name, q in QUARTILES.items():
            assert row[name] == pytest.approx(np.quantile(group, q), rel=1e-12), (row["g"], name)


@pytest.fixture
def score(spark):
    def make(*rows):
        return spark.createDataFrame(
            list(rows),
            "customer_id int, total_spend double, discretionary_ratio double, "
            "salary_to_spend_ratio double, sds_score int",
        )

    return make


def test_box_plot(score):
    spends = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = score(*[(i, s, 0.1, 1.0, 400) for i, s in enumerate(spends)], (9, 7.0, 0.1, 1.0, 500))
    rows = {r["sds_score"]: r for r in reports.spend_boxstats(df).collect()}
    box = rows[400]
    assert (box["n"], box["q1"], box["median"], box["q3"]) == (6, 2.25, 3.5, 4.75)
    assert (box["lo"], box["hi"], box["n_out"]) == (1.0, 5.0, 1)
    assert (rows[500]["q1"], rows[500]["n_out"]) == (7.0, 0)
    assert [tuple(r) for r in reports.spend_outliers(df).collect()] == [(400, 5, 100.0)]


def test_histogram_and_counts(score):
    df = score((1, 1.0, 0.0, 1.0, 400), (2, 1.0, 0.25, 1.0, 300), (3, 1.0, 0.25, 1.0, 400),
               (4, 1.0, None, 1.0, None))
    assert [tuple(r) for r in reports.score_histogram(df).collect()] == [(300, 1), (400, 2)]
    assert [tuple(r) for r in reports.ratio_counts(df).collect()] == [(0.25, 2), (0.0, 1)]


def test_buckets(score):
    df = score((1, 1.0, -0.1, 1.0, 1), (2, 1.0, 0.0, 1.0, 1), (3, 1.0, 0.5, 1.0, 1),
               (4, 1.0, 1.0, 1.0, 1), (5, 1.0, None, 1.0, 1))
    rows = reports.ratio_buckets(df, edges=(0.0, 0.5, 1.0)).collect()
    assert [tuple(r) for r in rows] == [
        (0, 1, None, 0.0), (1, 1, 0.0, 0.5), (2, 1, 0.5, 1.0), (3, 1, 1.0, None),
    ]


def test_share(score):
    df = score((1, 30.0, 0.6, 1.0, 1), (2, 60.0, 0.5, 1.0, 1), (3, 10.0, None, 1.0, 1))
    got = {r["kind"]: (r["total_spend"], r["percent"]) for r in reports.spend_share(df).collect()}
    assert got == {"Discretionary": (30.0, 30.0), "Non-Discretionary": (70.0, 70.0)}
    by_ratio = reports.spend_share(df, by="ratio")
    assert by_ratio.count() == 3
    assert by_ratio.agg(F.sum("percent")).first()[0] == pytest.approx(100.0)
    with pytest.raises(ValueError):
        reports.spend_share(df, by="x")


def test_top_spenders_break_ties_by_id(score):
    df = score(*[(i, 5.0, 0.1, 1.0, 1) for i in range(9, 0, -1)])
    assert [r["customer_id"] for r in reports.top_spenders(df, 3).collect()] == [1, 2, 3]


def test_correlations_skip_unknown_and_constant(score):
    rng = random.Random(2)
    data = [(i, rng.random(), rng.random() if i % 3 else None, 1.0, rng.randint(1, 9)) for i in range(50)]
    got = {(r["a"], r["b"]): r["r"] for r in reports.correlations(score(*data)).collect()}
    assert len(got) == 6
    known = [(d[1], d[2]) for d in data if d[2] is not None]
    assert got["total_spend", "discretionary_ratio"] == pytest.approx(np.corrcoef(*zip(*known))[0, 1])
    assert got["total_spend", "salary_to_spend_ratio"] is None


def test_scatter_samples_only_on_request(score):
    df = score(*[(i, 5.0, 0.1, 1.0, 1) for i in range(200)])
    assert reports.scatter_points(df).count() == 200
    assert 0 < reports.scatter_points(df, 0.5, seed=1).count() < 200
