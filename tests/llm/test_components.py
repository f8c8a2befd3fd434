from __future__ import annotations

import random

from spendscore.llm.components import connected


def roots(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r["node"]: r["root"] for r in connected(df).collect()}


def groups(found):
    out = {}
    for node, root in found.items():
        out.setdefault(root, set()).add(node)
    return sorted(map(sorted, out.values()))


def test_chain_star_and_ring(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(500, 501), (501, 502), (502, 500)]
    found = groups(roots(spark, edges))
    assert found == [list(range(61)), [500, 501, 502], list(range(1000, 1200))]


def test_random_graph(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(150), draw.randrange(150)) for _ in range(110)]
    parent = list(range(150))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[top(a)] = top(b)
    expected = {}
    for a, b in edges:
        for x in (a, b):
            if a != b or any(x in e and e[0] != e[1] for e in edges):
                expected.setdefault(top(x), set()).add(x)
    assert groups(roots(spark, edges)) == sorted(map(sorted, expected.values()))


def test_loops_nulls_and_no_edges(spark):
    assert roots(spark, [(1, 1), (None, 2), (3, None)]) == {}
    assert roots(spark, []) == {}
    assert groups(roots(spark, [(1, 2), (2, 1), (1, 2)])) == [[1, 2]]
