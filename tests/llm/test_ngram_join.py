from __future__ import annotations

import random

import pytest

from spendscore.llm.ngram_join import ngram_join, shingles


def brute(rows, length, percent):
    def grams(text):
        words = (text or "").encode().lower().split()
        return frozenset([tuple(words)] if 0 < len(words) < length else zip(*[words[k:] for k in range(length)]))

    sets = [grams(t) for _, t in rows]
    links = [[j for j, t in enumerate(sets) if i != j and s and t and 100 * len(s & t) >= percent * len(s | t)] for i, s in enumerate(sets)]
    out = []
    for start, (doc, _) in enumerate(rows):
        seen, todo = {start}, [start]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((doc or -1, len(sets[start]), min(ids) if ids else -1))
    return sorted(out)


def run(documents, rows, length, percent, **options):
    found = ngram_join(documents(*rows), length=length, percent=percent, **options).collect()
    return sorted((r["doc_id"] or -1, r["n_shingles"], -1 if r["component_id"] is None else r["component_id"]) for r in found)


def texts(seed, groups=14, size=70):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    rows, k = [], 1
    for _ in range(groups):
        text = draw.choices(words, k=draw.choice([12, size, 3 * size]))
        for _ in range(draw.choice([1, 3, 9])):
            rows.append((k, " ".join(text)))
            text = list(text)
            for _ in range(draw.choice([0, 1, 1, 2])):  # a chain of small edits
                text[draw.randrange(len(text))] = draw.choice(words)
            k += 1
    return rows


@pytest.mark.parametrize(("length", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_against_brute_force(documents, length, percent):
    rows = texts(length)
    assert run(documents, rows, length, percent) == brute(rows, length, percent)


def test_any_order_of_columns(documents):
    """A sketch of two counters orders the columns badly; no link is lost by it."""
    rows = texts(9)
    assert run(documents, rows, 3, 90, sketch_bits=1) == brute(rows, 3, 90)


def test_exactly_at_the_threshold(documents):
    base = [f"a{k}" for k in range(30)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:27])), (3, " ".join(base[:28])), (4, " ".join(base[3:]))]
    assert run(documents, rows, 1 + 1, 90) == brute(rows, 2, 90)


def test_odd_texts(documents):
    rows = [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c"), (4, "Hello World"), (5, "hello\tworld"), (6, "one"), (7, "É é"), (8, "é É"),
            (4, "Hello World"), (9, "x" * 100_000), (10, "ab " * 30_000), (None, "hello world"), (11, "a b c d"), (12, "a b c d")]
    assert run(documents, rows, 3, 90) == brute(rows, 3, 90)


def test_empty_and_limits(documents):
    assert run(documents, [], 3, 90) == []
    with pytest.raises(ValueError):
        ngram_join(documents(), percent=40)


def test_words_as_defined():
    assert len(shingles("A b\x1cC d e", 3)) == 1  # other separators belong to words
    assert (shingles("A B C", 3) == shingles("a b c", 3)).all()
