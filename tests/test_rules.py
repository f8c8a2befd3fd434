from __future__ import annotations

import random

import pytest

from spendscore.config import CATEGORY_EXAMPLES
from spendscore.operators import bronze, rules, text
from spendscore.operators.examples import nearest_of_many
from spendscore.sources import fixtures

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("hot_rows", [10**9, 3, 0])
def test_default_rules_as_a_table(spark, hot_rows):
    rows = bronze.debit_only(bronze.conform_transactions(fixtures.transactions(spark, SF)))
    got = rules.categorize_by_rules(rows, rules.rules_table(spark), hot_rows=hot_rows)
    expected = bronze.categorize(rows)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0


def brute(names, table, other="Other"):
    result = {}
    for name in names:
        found = [(number, category) for number, category, part in table if name is not None and part is not None and part in name]
        result[name] = min(found)[1] if found else other
    return result


def test_ten_thousand_rules_against_brute_force(spark):
    rng = random.Random(4)
    letters = "abcdeéß $%_"
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(800)] + [None, "", "a", "ab"]
    table = [(rng.randint(0, 3_000), f"c{rng.randint(0, 50)}", "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))) for _ in range(10_000)]
    table = [r for r in table if len(r[2]) > 2 or r[0] > 2_500] + [(2_900, "b", "_"), (2_900, "a", "_"), (5, "x", None)]
    df = spark.createDataFrame([(n,) for n in names] * 2, "merchant string")
    for extra in ([], [(2_950, "all", ""), (2_960, "never", "")]):
        given = spark.createDataFrame(table + extra, "rule long, category string, substring string")
        got = rules.categorize_by_rules(df, given).collect()
        assert len(got) == 2 * len(names)
        assert {r["merchant"]: r["category"] for r in got} == brute(names, table + extra)


def test_no_rules(spark):
    df = spark.createDataFrame([("a",), (None,)], "merchant string")
    none = spark.createDataFrame([], "rule long, category string, substring string")
    assert [r["category"] for r in rules.categorize_by_rules(df, none).collect()] == ["Other"] * 2


def example_table(spark, groups):
    flat = [(label, name) for label, names in groups for name in names]
    return spark.createDataFrame([(k, label, name) for k, (label, name) in enumerate(flat)], "example long, label string, name string")


@pytest.mark.parametrize("postings", [1000, 2, 1])
@pytest.mark.parametrize("options", [{}, {"tokenizer": "char3", "min_similarity": 0.1}])
def test_example_table_gives_the_rows_of_the_list(spark, options, postings):
    debit = bronze.debit_transactions(bronze.conform_transactions(fixtures.transactions(spark, SF)))
    got = nearest_of_many(debit, example_table(spark, CATEGORY_EXAMPLES), postings=postings, **options)
    expected = text.nearest_category(debit, CATEGORY_EXAMPLES, **options)
    tidy = lambda df: sorted(((r["merchant"], r["n_rows"], r["category"], r["similarity"] and round(r["similarity"], 9)) for r in df.collect()), key=repr)
    assert tidy(got) == tidy(expected)


def test_long_list_against_brute_force(spark):
    """100,000 examples with frequent tokens; ties go to the earlier example."""
    import math
    from collections import Counter

    rng = random.Random(6)
    words = [f"word{k}" for k in range(3_000)]
    usual = ["store", "shop", "market", "online"]
    listed = [(f"L{k % 7}", " ".join([rng.choice(usual)] * rng.randint(0, 1) + [rng.choice(usual)] + rng.sample(words, rng.randint(0, 2)))) for k in range(100_000)]
    names = [f"{rng.choice(usual)} {rng.choice(words)}" for _ in range(10)] + ["store", "shop online", "Market market 12", "unknown thing", None, "x"]
    names += [" ".join(rng.sample(words, 2)) + " online" for _ in range(8)]

    def tokens(name):
        return Counter(w for w in "".join(c.lower() if c.isalnum() else " " for c in name).split() if len(w) > 1)

    vectors = [tokens(name) for _, name in listed]
    found = Counter(w for v in vectors for w in v)
    idf = {w: math.log((1 + len(listed)) / (1 + n)) + 1 for w, n in found.items()}
    unit = []
    for v in vectors:
        size = math.sqrt(sum((n * idf[w]) ** 2 for w, n in v.items()))
        unit.append({w: n * idf[w] / size for w, n in v.items()})
    df = spark.createDataFrame([(n,) for n in names], "merchant string")
    given = spark.createDataFrame([(k, *row) for k, row in enumerate(listed)], "example long, label string, name string")
    got = {r["merchant"]: (r["category"], r["similarity"]) for r in nearest_of_many(df, given).collect()}
    for name in names:
        if name is None:
            assert got[name] == (None, None)
            continue
        own = {w: n * idf[w] for w, n in tokens(name).items() if w in idf}
        size = math.sqrt(sum(x * x for x in own.values())) or 1.0
        similar = [round(sum(x * v.get(w, 0.0) for w, x in own.items()) / size, 12) for v in unit]
        best = max(similar)
        assert got[name][1] == pytest.approx(best, abs=1e-11), name
        near = {listed[k][0] for k, s in enumerate(similar) if abs(s - best) < 3e-12}
        assert got[name][0] in near and (len(near) > 1 or got[name][0] == listed[similar.index(best)][0])
