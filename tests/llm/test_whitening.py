from __future__ import annotations

import math

import numpy as np
import pytest

from spendscore.llm.whitening import numbered, whitened
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, `at` string, `a.b` string, number int, blockId int"


def table(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "clash", "clash", "clash", "clash", 1, 2) for i, v in rows], SCHEMA)


def run(spark, rows, **options):
    return whitened(table(spark, rows), **options).toPandas()


def brute(rows, components):
    """Ids, deviations, whitened up to a sign for each component, explained shares and the number of distinct vectors."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.asarray([v for _, v in good], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [i for i, _ in good], deviation, (n * x - sums) / n @ axes[:, :components], values[:components], values.sum(), n


def holds(out, rows, components):
    ids, deviation, on_axes, values, trace, n = brute(rows, components)
    expected = on_axes / np.sqrt(values)
    assert len(out) == len(ids) * components and (out["n"] == n).all()
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    for k in range(components):
        part = out[out["component"] == k + 1]
        got = np.asarray(sorted(zip(part["vec_id"], part["deviation"], part["whitened"].round(7))), float)
        sides = [np.asarray(sorted(zip(ids, deviation, (sign * expected[:, k]).round(7))), float) for sign in (1, -1)]
        assert any(np.allclose(got, side, rtol=0, atol=1e-6) for side in sides)
        assert part["explained"].iloc[0] == pytest.approx(values[k] / trace, rel=1e-9)


def drawn(n, dim, seed):
    draw = np.random.default_rng(seed)
    mix = draw.standard_normal((dim, dim)) * np.linspace(0.5, 4, dim)
    return [(int(i), (draw.standard_normal(dim) @ mix).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("rows_per_block", [None, 7, 200])
def test_equals_numpy(spark, rows_per_block):
    rows = drawn(200, 6, 1)
    holds(run(spark, rows, rows_per_block=rows_per_block, components=4), rows, 4)


def test_many_blocks_and_copies(spark):
    rows = drawn(90, 5, 2)
    rows += [(1000 + k, rows[0][1]) for k in range(60)]  # copies weigh nothing
    rows += rows[:10]  # repeated rows are rows
    holds(run(spark, rows, rows_per_block=4), rows, 5)


def test_odd_rows(spark):
    good = drawn(60, 4, 3)
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0]), (203, [math.nan] * 4), (204, [math.inf, 0, 0, 0]), (205, [1e30, 0, 0, 0]), (206, [1.0, 2.0])]
    holds(run(spark, good + odd), good, 4)
    out = run(spark, [*good, (None, good[0][1])])
    assert out["vec_id"].isna().sum() == 4


def test_fewer_vectors_than_components(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0]), (3, [2.0, 2.0, 3.0])]
    out = run(spark, rows).sort_values(["vec_id", "component"])
    assert len(out) == 9 and (out["n"] == 2).all() and out["identity_error"].iloc[0] < 1e-12
    first = out[out["component"] == 1]
    assert sorted(first["whitened"].round(9)) in ([-1.0, 1.0, 1.0], [-1.0, -1.0, 1.0]) and (first["explained"] == 1).all()
    assert out[out["component"] > 1]["whitened"].isna().all()
    assert list(first["deviation"]) == [64**2] * 3


def test_one_vector_has_no_variance(spark):
    out = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert len(out) == 4 and (out["n"] == 1).all() and (out["deviation"] == 0).all()
    assert out[["whitened", "explained", "identity_error"]].isna().all().all()


def test_deviation_beyond_long_is_null(spark):
    rows = [(k, [float(k % 7) * 2.0**23 / 7, float(k)]) for k in range(200)]
    out = run(spark, rows, components=1)
    exact = {i: int(d) for i, d in zip(*brute_exact(rows))}
    for i, d in zip(out["vec_id"], out["deviation"]):
        assert (np.isnan(d) if exact[i] >= 2**63 else d == pytest.approx(exact[i], rel=1e-15))
    assert out["deviation"].isna().any()


def brute_exact(rows):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    return [i for i, _ in rows], [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]


def test_empty(spark):
    assert len(run(spark, [])) == len(run(spark, [(1, None)])) == 0
    assert whitened(table(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_numbers_have_no_gap(spark):
    rows = spark.range(0, 57, 1, 5).select(F.monotonically_increasing_id().alias("at"))
    assert sorted(r["number"] for r in numbered(rows).collect()) == list(range(57))
