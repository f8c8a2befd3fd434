from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pytest

from spendscore.llm import mixing
from spendscore.llm.mixing import mixed_sources


def brute(rows, entropy, repeats, budget):
    sized = [(i, s, len((t or "").split())) for i, t, _, s in rows]
    sums = defaultdict(int)
    for _, s, n in sized:
        if n:
            sums[s] += n
    total = sum(sums.values())
    shares = {s: n / total for s, n in sums.items()}

    def state(a):
        z = math.fsum(p**a for p in shares.values())
        h = math.log(z) - a * math.fsum(p**a * math.log(p) for p in shares.values()) / z
        return h, max(p ** (a - 1) for p in shares.values()) * budget / z

    def bisected(met):
        low, high = 0.0, 1.0
        for _ in range(24):
            middle = (low + high) / 2
            low, high = (low, middle) if met(*state(middle)) else (middle, high)
        return high

    a = 1.0
    if len(shares) > 1:
        goal = entropy * math.log(len(shares))
        wanted = 1.0 if state(1.0)[0] >= goal else bisected(lambda h, _: h < goal)
        allowed = 0.0 if state(0.0)[1] <= repeats + 1e-6 else bisected(lambda _, m: m <= repeats + 1e-6)
        a = round(max(wanted, allowed), 6)
    z = math.fsum(p**a for p in shares.values())
    out = []
    for source, n in sums.items():
        full, rest = divmod(math.floor(shares[source] ** a / z * budget * total + 1e-6), n)
        own = [(i, t) for i, s, t in sized if s == source and t]

        def place(i, block):
            return hashlib.md5(f"{'' if i is None else i}:{block}".encode()).hexdigest()

        drawn = 0
        taken = set()
        for at in sorted({place(i, full) for i, _ in own}):
            drawn += sum(t for i, t in own if place(i, full) == at)
            if drawn <= rest:
                taken.add(at)
        for i, t in own:
            out += [(i, source, t, b, place(i, b)) for b in range(full + (place(i, full) in taken))]
    return a, sorted(out, key=str)


def run(documents, rows, entropy=0.97, repeats=4.0, budget=1.0):
    found = mixed_sources(documents(*rows), entropy, repeats, budget).collect()
    return sorted(((r["doc_id"], r["source"], r["n_tokens"], r["block"], r["place"]) for r in found), key=str)


def rows(sizes):
    return [(1000 * k + j, "word " * (1 + (j * 7) % 23), "en", f"s{k}") for k, n in enumerate(sizes) for j in range(n)]


@pytest.mark.parametrize(("entropy", "repeats", "budget"), [(0.97, 4.0, 1.0), (1.0, 100.0, 1.0), (0.9, 1.5, 0.5), (0.0, 4.0, 3.0), (0.99, 0.4, 1.0), (0.95, 9.0, 0.01)])
def test_against_brute_force(documents, entropy, repeats, budget):
    table = rows([90, 30, 12, 4])
    assert run(documents, table, entropy, repeats, budget) == brute(table, entropy, repeats, budget)[1]


def test_target_is_met(documents):
    table = rows([400, 100, 60, 40])
    a, drawn = brute(table, 0.97, 4.0, 1.0)
    assert 0 < a < 1 and run(documents, table) == drawn
    tokens = defaultdict(int)
    for _, source, n, _, _ in drawn:
        tokens[source] += n
    shares = [n / sum(tokens.values()) for n in tokens.values()]
    assert abs(-sum(p * math.log(p) for p in shares) / math.log(4) - 0.97) < 0.01


def test_odd_rows(documents):
    table = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t", "en", "b"), (4, "one two", "en", None), (5, "x " * 50_000, "en", "a"),
             (6, "one", "en", "c"), (6, "one", "en", "c"), (None, "one two three", "en", "c"), (7, "a b", "en", None)]
    assert run(documents, table, budget=2.0) == brute(table, 0.97, 4.0, 2.0)[1]


def test_one_source_and_none(documents):
    table = rows([9])
    assert run(documents, table, budget=2.5) == brute(table, 0.97, 4.0, 2.5)[1]
    assert run(documents, [(1, None, "en", "a")]) == [] and run(documents, []) == []
    with pytest.raises(ValueError):
        mixed_sources(documents(), budget=0)


def test_columns_stay(documents):
    out = mixed_sources(documents(*rows([3, 2])))
    assert {"lang", "n_chars", "cls", "block"} <= set(out.columns) and len(out.columns) == len(set(out.columns))


def test_buckets_within_buckets(documents, monkeypatch):
    """The place where a source's tokens run out is found level by level, whatever a bucket may hold."""
    table = rows([300, 90, 20]) + [(1_000 + 7, "word " * 4, "en", "s1")] * 5  # documents of one place
    monkeypatch.setattr(mixing, "DIGITS", 1)
    for most in (10**6, 3, 0):
        monkeypatch.setattr(mixing, "BUCKET_PLACES", most)
        assert run(documents, table, 0.97, 4.0, 1.3) == brute(table, 0.97, 4.0, 1.3)[1]
