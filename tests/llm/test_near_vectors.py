from __future__ import annotations

import numpy as np
import pytest

from spendscore.llm.near_vectors import CapFilters, decode, near_vectors, unit_vector

SCHEMA = "vec_id long, embedding array<float>, label int, cls string"


def brute(rows, cosine=0.95):
    units = [unit_vector(None if v is None else [None if x is None else np.float32(x) for x in v]) for _, v in rows]
    links = [[j for j, w in enumerate(units) if i != j and u is not None and w is not None and len(u) == len(w) and u @ w >= cosine]
             for i, u in enumerate(units)]
    names = []
    for start in range(len(rows)):
        seen, todo = {start}, [start]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        names.append(min(ids) if ids else None)
    return sorted((r[0] or -1, len(n), c if c is not None else -1) for r, n, c in zip(rows, links, names))


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows], SCHEMA)
    out = near_vectors(df, **options).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in out)
    return sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] if r["component_id"] is not None else -1) for r in out)


def test_groups_chains_and_copies(spark):
    draw = np.random.default_rng(1)
    rows, k = [], 1
    for centre in draw.standard_normal((12, 16)):
        step = draw.standard_normal(16) * 0.12
        for n in range(6):  # a chain whose ends don't link
            rows.append((k, (centre + n * step).astype(np.float32)))
            k += 1
    rows += [(500 + n, rows[0][1]) for n in range(5)]  # copies
    rows += [(600, rows[5][1] * 3), (601, -rows[5][1])]  # the same direction, the opposite one
    assert run(spark, rows, hits=40) == brute(rows)


def test_large_bucket_in_chunks(spark):
    draw = np.random.default_rng(2)
    base = draw.standard_normal(16)
    rows = [(n, (base + 0.1 * draw.standard_normal(16)).astype(np.float32)) for n in range(1, 300)]
    assert run(spark, rows, hits=40, chunk=40) == brute(rows)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 3.0, 4.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0, 0, 0]),
            (7, one), (7, one), (8, one), (None, one), (9, one + [5.0]), (10, [-0.0, 1.0, 0, 0]), (11, [0.0, 1.0, 0, 0]),
            (12, [1e-38, 2e-38, 3e-38, 4e-38])]
    assert run(spark, rows, hits=60) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_recall_at_the_threshold():
    """Pairs at exactly the cosine share a filter nearly always, by the filters' own rule."""
    draw = np.random.default_rng(3)
    filters = CapFilters.fitted(64, 20_000, 0.95)
    first = draw.standard_normal((400, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other = draw.standard_normal((400, 64))
    other -= (other * first).sum(1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    second = 0.95 * first + (1 - 0.95**2) ** 0.5 * other
    codes = [set() for _ in range(800)]
    for row, code in zip(*decode(filters, np.concatenate([first, second]))):
        codes[row].add(code)
    assert np.mean([bool(codes[k] & codes[k + 400]) for k in range(400)]) >= 0.98


@pytest.mark.parametrize("rows", [2_000, 10**6, 10**7, 3 * 10**7, 10**8])
def test_recall_does_not_fall_with_the_rows(rows):
    draw = np.random.default_rng(3)
    filters = CapFilters.fitted(64, rows, 0.95)
    first, other = draw.standard_normal((2, 400, 64))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (other * first).sum(1, keepdims=True) * first
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    units = np.concatenate([first, 0.95 * first + (1 - 0.95**2) ** 0.5 * other])
    codes = [set() for _ in units]
    for start in range(0, len(units), 100):
        for row, code in zip(*decode(filters, units[start : start + 100])):
            codes[start + row].add(code)
    shared = [len(codes[k] & codes[k + 400]) for k in range(400)]
    assert abs(np.mean(shared) - 20) < 3
    assert np.mean(np.array(shared) > 0) >= 0.98


def test_decoding_finds_every_cap():
    draw = np.random.default_rng(4)
    filters = CapFilters(12, 3, 7, 0.3)
    units = draw.standard_normal((50, 12))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    from spendscore.llm.near_vectors import _directions

    rotation, words = _directions(filters)
    turned = units @ rotation
    expected = set()
    for a in range(7):
        for b in range(7):
            for c in range(7):
                direction = np.concatenate([words[0][a], words[1][b], words[2][c]])
                expected |= {(r, (a * 7 + b) * 7 + c) for r in np.flatnonzero(turned @ direction >= 0.3)}
    assert set(zip(*map(lambda x: x.tolist(), decode(filters, units)))) == expected
