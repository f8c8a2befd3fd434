from __future__ import annotations

import math
import random
import zlib

import pytest

from spendscore.llm import toxicity as module
from spendscore.llm.toxicity import BINS, EXCEPTIONS, STEMS, Matcher, boundary, folded, learned_lexicon, toxicity

BAD = ["wretch", "swine", "fool"]


def table(seed=4, n=400):
    draw = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = draw.choices(["sun", "rain", "house", "road", "tree", "river", "stone"], k=60)
        toxic = k % 5 == 0
        for _ in range(4 if toxic else 0):
            words[draw.randrange(60)] = draw.choice(BAD)
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def run(spark, documents, rows, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'clash' AS text", "1 AS id")
    return toxicity(documents(*rows), known).collect()


def test_folding():
    assert folded("ІDI0T, 1d1οt!! f00l c!own $cum tr@sh É") == " idiot idiot fool ciown scum trash e "
    assert folded(None) == folded("") == folded("? 2 !") == ""
    assert folded("THE!! end") == " the end "


def test_matching():
    m = Matcher({" fool ": 2.0, " foolis": 3.0, " clown ": 4.0})
    assert m.feature("fool fool") == (4.0 / 12, 2)  # neighbours share a blank
    assert m.feature("foolishness") == (3.0 / 11, 1) and m.feature("tomfoolery") == (0.0, 0)
    assert m.feature("a clown fish, a CLOWN") == (4.0 / 15, 1)  # the phrase is an exception
    assert m.feature(None) == m.feature("") == (0.0, 0)


def test_held_out_rows(spark, documents):
    rows, labels = table()
    rows += [(1000, None), (1001, ""), (1002, "w" * 200_000), (1003, "wr3tch  ѕwine f00l"), (1004, "sun " * 50_000), (1003, "wr3tch  ѕwine f00l")]
    found = run(spark, documents, rows, labels)
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(by_id[i]["predicted"] == toxic for i, _, toxic in labels)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert [by_id[i]["predicted"] for i in range(1000, 1005)] == [0, 0, 0, 1, 0]


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    rows, labels = table()
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    assert {tuple(r) for r in run(spark, documents, rows, labels)} == {tuple(r) for r in run(spark, documents, rows, turned)}


def test_nothing_learned(spark, documents):
    rows = [(k, "some words") for k in range(8)]
    for labels in ([], [(k, 1, 0) for k in range(8)], [(k, 1, None) for k in range(8)], [(k, 1, 7) for k in range(8)]):
        assert {(r["score"], r["predicted"]) for r in run(spark, documents, rows, labels)} == {(0.0, 0)}
    assert run(spark, documents, [], []) == []


def brute_lexicon(rows):
    """Weights from (text, toxic) by the definition: entries, counts over rows, ratio less its errors."""
    def entries(text):
        words = folded(text).split()
        return {f" {w} " for w in words if len(w) > 2} | {f" {w[:k]}" for w in words for k in STEMS if k < len(w)}

    bad, good = [entries(t) for t, x in rows if x == 1], [entries(t) for t, x in rows if x == 0]
    found = {}
    for e in set().union(*bad) if bad else ():
        n, m = sum(e in b for b in bad), sum(e in g for g in good)
        ratio = math.log((n + 0.5) / (len(bad) + 1)) - math.log((m + 0.5) / (len(good) + 1))
        if n >= 4 and ratio - 1.64 * math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5)) >= math.log(8):
            found[e] = ratio
    return found


def brute_feature(lexicon, text):
    """Every word's heaviest entry, found by comparing, but where an exception phrase covers the word."""
    line = folded(text)
    words, total = line.split(), 0.0
    excused = set()
    for phrase in EXCEPTIONS:
        own = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(own)] == own:
                excused.update(range(k, k + len(own)))
    for k, w in enumerate(words):
        fits = [x for e, x in lexicon.items() if (e[-1] == " " and f" {w} " == e) or (e[-1] != " " and f" {w}".startswith(e))]
        if fits and k not in excused:
            total += max(fits)
    return total / (len(words) + 10)


def test_against_brute_force(spark, documents):
    draw = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("gor", "lim", "pas", "tun") for b in ("e", "i", "o") for c in ("ban", "dor", "lit", "nak", "rem")]
    rows, labels = [], []
    for k in range(500):
        toxic = draw.random() < 0.2
        text = draw.choices(words, k=draw.randint(0, 40)) + draw.choices(["idiot", "f00lish", "foolery", "rare" + "xyz"[k % 3]], k=3 if toxic else draw.random() < 0.03)
        draw.shuffle(text)
        rows.append((k, " ".join(text) + draw.choice(["", " idiot proof", " clown fish"])))
        labels.append((k, 1, int(toxic)))
    training = [(t, x) for (k, t), (_, _, x) in zip(rows, labels) if zlib.crc32(str(k).encode()) % 4 != 2]
    lexicon = brute_lexicon(training)
    got = learned_lexicon(spark.createDataFrame(training, "text string, toxic int"))
    assert got == pytest.approx(lexicon) and 5 < len(lexicon)
    features = {k: brute_feature(lexicon, t) for k, t in rows}
    known = [(features[k], x) for (k, _), (_, _, x) in zip(rows, labels) if zlib.crc32(str(k).encode()) % 4 != 2]
    top = max(f for f, _ in known)
    wrong = {c: sum((math.floor(f / top * BINS) >= c) != x for f, x in known) for c in range(1, BINS + 1)}
    best = [c for c in wrong if wrong[c] == min(wrong.values())]
    cut = (best[0] + best[-1]) / 2 / BINS * top
    assert boundary(spark.createDataFrame(known, "feature double, toxic int")) == pytest.approx(cut)
    for r in run(spark, documents, rows, labels):
        f = features[r["doc_id"]]
        assert r["score"] == pytest.approx(f / (f + cut * 0.7 / 0.3), abs=1e-12) and r["predicted"] == int(r["score"] >= 0.3)


def test_a_lexicon_has_a_size(spark, monkeypatch):
    rows = [("good " + k, 0) for k in "abcdefgh"] * 40 + [("bad worse worst " + k, 1) for k in "abcdefgh"] * 20
    df = spark.createDataFrame(rows, "text string, toxic int")
    assert len(learned_lexicon(df)) == 3
    monkeypatch.setattr(module, "MOST_ENTRIES", 2)
    with pytest.raises(ValueError, match="2 at most"):
        learned_lexicon(df)
