from __future__ import annotations

import random
import re
from itertools import combinations

import pytest

from spendscore.llm.decontaminate import contaminated, spaced_masks, tolerated


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items, window=13, percent=80, least=5):
    best = {}
    for doc, text in docs:
        own = words(text)
        for item, other in items:
            theirs = words(other)
            n = len(theirs)
            if n < least:
                continue
            span = min(window, n)
            for shift in range(-n + 1, len(own)):
                equal = [0 <= shift + k < len(own) and own[shift + k] == w for k, w in enumerate(theirs)]
                for s in range(n - span + 1):
                    hit = sum(equal[s : s + span])
                    if 100 * hit >= percent * span:
                        key = (hit, sum(equal), -(shift + s), span, n)
                        best[doc, item] = max(best.get((doc, item), key), key)
    return sorted((d, i, -b[2], b[0], b[3], b[1], b[4]) for (d, i), b in best.items())


def run(spark, documents, docs, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'clash' AS doc_id", "1 AS n", "'x' AS hash")
    found = contaminated(documents(*docs), benchmark, **options).collect()
    assert all(r["overlap"] == r["n_equal"] / r["span"] for r in found)
    return sorted((r["doc_id"], r["item_id"], r["start"], r["n_equal"], r["span"], r["n_equal_item"], r["n_item"]) for r in found)


@pytest.mark.parametrize(("length", "misses"), [(13, 2), (12, 2), (9, 1), (7, 1), (5, 1), (5, 0), (1, 0), (20, 4)])
def test_masks_lose_no_passage(length, misses):
    masks = spaced_masks(length, misses)
    for gap in combinations(range(length), misses):
        assert any(
            all(not (c == "1" and o + k in gap) for k, c in enumerate(m)) for m in masks for o in range(length - len(m) + 1)
        ), (masks, gap)
    assert tolerated(13, 80) == 2 and tolerated(10, 80) == 2 and tolerated(9, 80) == 1


def test_substituted_passages(spark, documents):
    draw = random.Random(3)
    pool = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(draw.choices(pool, k=n))) for k, n in enumerate([5, 6, 9, 10, 12, 13, 14, 20, 37, 60, 4])]
    items += [(100, items[7][1]), (101, items[8][1].upper() + "!")]  # equal items
    docs, k = [], 0
    for _ in range(60):
        text = draw.choices(pool, k=draw.randrange(0, 80))
        passage = words(draw.choice(items)[1])
        start = draw.randrange(len(passage))
        passage = passage[start : start + draw.choice([13, 14, 30, 60])] if draw.random() < 0.5 else passage
        for _ in range(draw.choice([0, 1, 2, 3, 5])):
            passage[draw.randrange(len(passage))] = draw.choice(pool)
        at = draw.randrange(len(text) + 1)
        docs.append((k, " ".join(text[:at]) + "  " + ", ".join(passage) + "\n" + " ".join(text[at:])))
        k += 1
    found = run(spark, documents, docs, items)
    assert found == brute(docs, items) and len({x[0] for x in found}) > 15


def test_odd_rows(spark, documents):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = [(1, passage), (2, None), (3, ""), (4, "x y"), (5, "é ü ß ø å")]
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (4, ("filler " * 40_000) + passage), (5, "É ü ß ø å é ü ß ø å"),
            (6, passage.split()[0]), (7, "?!"), (8, "alpha-beta.GAMMA,delta epsilon zeta eta theta iota kappa lambda mu")]
    expected = brute(sorted(set(docs), key=str), items)
    assert run(spark, documents, docs, items) == expected and {x[0] for x in expected} == {3, 4, 5, 8}


def test_empty_sides(spark, documents):
    assert run(spark, documents, [], [(1, "a b c d e f")]) == []
    assert run(spark, documents, [(1, "a b c d e f")], []) == []
