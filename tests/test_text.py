from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from spendscore.config import CATEGORY_EXAMPLES
from spendscore.operators import text


def word_tokens(name):
    return re.findall(r"\b\w\w+\b", name.lower())


def trigram_tokens(name):
    flat = re.sub(r"\s\s+", " ", name.lower())
    return [flat[i : i + 3] for i in range(len(flat) - 2)]


def brute(name, tokenize):
    """(similarity, label) of the nearest example, computed one by one."""
    flat = [(label, example) for label, examples in CATEGORY_EXAMPLES for example in examples]
    seen = Counter(token for _, example in flat for token in set(tokenize(example)))

    def vector(value):
        weights = {
            token: tf * (math.log((1 + len(flat)) / (1 + seen[token])) + 1)
            for token, tf in Counter(tokenize(value)).items()
            if token in seen
        }
        length = math.sqrt(sum(w * w for w in weights.values()))
        return {token: w / length for token, w in weights.items()}

    mine = vector(name)
    similar = [
        round(sum(w * other.get(token, 0.0) for token, w in mine.items()), 12)
        for other in (vector(example) for _, example in flat)
    ]
    best = max(range(len(flat)), key=lambda i: (similar[i], -i))
    return similar[best], flat[best][0]


@pytest.mark.parametrize(("tokenizer", "tokenize"), [("word", word_tokens), ("char3", trigram_tokens)])
def test_nearest_against_brute_force(spark, tokenizer, tokenize):
    rng = random.Random(4)
    pieces = ["amazon", "prime", "uber", "eats", "visa", "hydro", "bc", "emi", "x", "Spotfy", "netflx", "  "]
    names = {" ".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(60)}
    names |= {"Enbrdge", "enbridge enbridge gas", "ab", ""}
    df = spark.createDataFrame([(name,) for name in sorted(names)], "merchant string")
    rows = text.nearest_category(df, tokenizer=tokenizer).collect()
    assert len(rows) == len(names)
    for row in rows:
        similarity, label = brute(row["merchant"], tokenize)
        assert row["similarity"] == pytest.approx(similarity, abs=1e-9), row
        assert row["category"] == label, row


def test_typos(spark):
    df = spark.createDataFrame([("Enbrdge",), ("netflx",), ("spotfy",)], "merchant string")
    near = {r["merchant"]: (r["category"], round(r["similarity"], 3))
            for r in text.nearest_category(df, tokenizer="char3").collect()}
    # 3 of 6 and 2 of 5 runs of equal weight: 3 / sqrt(18) and 2 / sqrt(10); in the
    # second name "fli" is shared with flights and weighs less
    assert near == {"Enbrdge": ("Utilities", 0.707), "netflx": ("Subscriptions", 0.793),
                    "spotfy": ("Subscriptions", 0.632)}
    # as a word the misspelt name is unknown, and the first label is taken
    words = {r["merchant"]: (r["category"], r["similarity"])
             for r in text.nearest_category(df).collect()}
    assert words["Enbrdge"] == ("Rent", 0.0)


def test_min_similarity_ranks_and_null(spark):
    df = spark.createDataFrame([("visa",), ("visa",), ("nothing known",), (None,)], "merchant string")
    rows = {r["merchant"]: r for r in text.nearest_category(df, min_similarity=0.3).collect()}
    assert rows["visa"]["category"] == "Credit Repayment" and rows["visa"]["n_rows"] == 2
    assert rows["nothing known"]["category"] == "Other"
    assert rows[None]["category"] is None
    several = text.nearest_category(
        spark.createDataFrame([("amazon prime",)], "merchant string"), k=5
    ).orderBy("rank").collect()
    assert [(r["rank"], r["category"]) for r in several] == [
        (1, "Subscriptions"), (2, "Misc. Discretionary"),
    ]


@pytest.mark.parametrize("hot_rows", [10**9, 1, 0])
def test_every_row_gets_its_label(spark, hot_rows):
    names = ["visa"] * 5 + ["zillow"] * 2 + ["costco", None, None]
    df = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "id int, merchant string")
    rows = text.label_nearest(df, hot_rows=hot_rows).orderBy("id").collect()
    assert [r["category"] for r in rows] == (
        ["Credit Repayment"] * 5 + ["Rent"] * 2 + ["Food & Groceries", None, None]
    )
