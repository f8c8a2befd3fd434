from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendscore.llm.hard_negatives import Best, hard_negatives, numbers_of, planes_of, scores, subset_sums

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, anchor string, planes string, `a.b` string, list int"


def table(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if c is None else float(c) for c in v], label, "clash", "clash", "clash", "clash", "clash", 1)
         for i, v, label in rows], SCHEMA)


def brute(rows, every=3, scale=256, positives=5, negatives=5):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, tuple(math.floor(scale * float(np.float32(c))) for c in v), label))
    lengths = sorted({len(x) for _, x, _ in kept}, key=lambda d: (-sum(len(x) == d for _, x, _ in kept), -d))
    kept = sorted({row for row in kept if len(row[1]) == lengths[0]}) if lengths else []
    out = []
    for a, ax, al in kept:
        if a % every:
            continue
        scored = {(-sum(p * q for p, q in zip(ax, x)), i, label) for i, x, label in kept}
        near = sorted({(s, i) for s, i, label in scored if label == al and i != a})[:positives]
        for ps, p in near:
            other = sorted({(s, i) for s, i, label in scored if label != al and 80 * -ps <= 100 * -s <= 100 * -ps})[:negatives]
            out += [(a, p, rank + 1, i, -ps, -s) for rank, (s, i) in enumerate(other)]
    return sorted(out)


def run(spark, rows, **options):
    out = hard_negatives(table(spark, rows), F.col("vec_id") % 3 == 0, **options)
    return sorted(map(tuple, out.collect()))


def drawn(n, dim, seed, spread=0.5, labels=3):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, dim))
    return [(int(i), (centres[i % 6] + spread * draw.standard_normal(dim)).astype(np.float32).tolist(), int(draw.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dim, high", [(1, 3), (8, 300), (13, 70_000), (64, 1 << 24)])
def test_lookups_give_inner_products(dim, high):
    draw = np.random.default_rng(dim)
    rows, anchors = draw.integers(-high, high + 1, (50, dim)), draw.integers(-high, high + 1, (7, dim))
    rows[0], anchors[0] = -high, -high
    planes = int(high).bit_length() + 1
    packed = planes_of(rows, planes)
    assert (numbers_of(packed, planes, dim) == rows).all()
    assert (scores(packed, subset_sums(anchors, planes)) == rows @ anchors.T).all()


def test_best_in_any_order():
    draw = np.random.default_rng(3)
    number, ids, score = draw.integers(0, 4, 500), draw.integers(0, 40, 500), draw.integers(-5, 5, 500)
    best = Best(4, 6)
    for part in np.array_split(np.arange(500), 9):
        best.add(number[part], ids[part], score[part])
    got = sorted(map(tuple, best.frame().to_numpy().tolist()))
    assert got == sorted((k, i, -s) for k in range(4) for s, i in sorted({(-s, i) for n, i, s in zip(number, ids, score) if n == k})[:6])


def test_equals_brute_force(spark):
    rows = drawn(400, 10, 1)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 500


def test_many_slabs_give_the_same(spark):
    rows = drawn(150, 5, 2)
    assert run(spark, rows, slab=9) == run(spark, rows) == brute(rows)


def test_copies_ties_and_repeated_rows(spark):
    rows = drawn(30, 4, 4)
    one = rows[0][1]
    rows += [(100 + k, one, k % 3) for k in range(60)]  # copies of all labels: ties go by id
    rows += rows[:20]  # repeated rows count once
    rows += [(3, rows[7][1], 1), (3, one, 2)]  # one id, other vectors
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    good = drawn(30, 4, 5)
    odd = [(200, None, 1), (201, [], 1), (202, [1.0, None, 1.0, 1.0], 1), (203, [math.nan] * 4, 1), (204, [math.inf, 0, 0, 0], 2), (None, good[0][1], 1),
           (205, good[0][1], None), (206, [1.0, 2.0], 1), (207, [1e30, 0.0, 0.0, 0.0], 1), (209, [0.0] * 4, 1), (210, [-1.0, -2.0, -3.0, -4.0], 0)]
    assert run(spark, good + odd) == brute([r for r in good + odd if r[0] != 207])


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, None, 1)]) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert run(spark, [(3, [1.0], 1), (2, [1.0], 2)]) == []  # no positive
    assert hard_negatives(table(spark, []), F.col("vec_id") == 1).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
