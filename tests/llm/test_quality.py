from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spendscore.llm import common
from spendscore.llm import quality as module
from spendscore.llm.quality import WordModel, _Numbers, kneser_ney, packed, perplexities, quality, shape, trigrams, unpacked, vocabulary_of

WORDS = ["the", "sun", "and", "rain", "over", "a", "house", "of", "stone", "by", "river"]


def good(draw, n=60):
    out = []
    for _ in range(n // 6):
        sentence = draw.choices(WORDS, k=5) + [draw.choice(["road", "tree", "hill"]) + "."]
        out.append(sentence[0].capitalize() + " " + " ".join(sentence[1:]))
    return " ".join(out)


def bad(draw, n=40):
    return " ".join(w.upper() + "!!" if draw.random() < 0.5 else w + "***" for w in draw.choices(WORDS, k=n))


def table(n=240):
    draw = random.Random(6)
    rows = [(k, bad(draw) if k % 6 == 0 else good(draw), ("en", "de")[k % 2], "s") for k in range(n)]
    return rows, [(k, int(k % 6 != 0), 0) for k in range(n)]


def run(spark, documents, rows, labels):
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'clash' AS lang", "1 AS n")
    return quality(documents(*rows), known).collect()


def test_shapes():
    assert [shape(w) for w in ("the", "The", "THE!!", "a***", "555-1234", "x@y.z", "é|")] == ["~a", "~Aa", "~A!", "~a*", "~0-0", "~a@a.a", "~a|"]


def test_probabilities_by_the_formulas(spark):
    """The table against modified Kneser-Ney written out; each context's probabilities add up to one."""
    draw = random.Random(8)
    texts = [" ".join(draw.choices("a b c d e f".split(), [9, 5, 4, 3, 2, 1], k=draw.randrange(1, 30))) for _ in range(60)]
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    vocabulary, _ = vocabulary_of(df, 40)
    table, width = np.exp(kneser_ney(df, vocabulary).astype(float)), len(vocabulary)
    assert np.allclose(table.reshape(-1, width).sum(axis=1), 1, atol=1e-5)
    numbers = _Numbers(list(vocabulary))
    three = Counter(g for t in texts for g in trigrams(t, numbers, width).tolist())
    two = Counter(g % width**2 for g in three)
    one = Counter(g % width for g in two)

    def discounts(counts):
        n = [max(1, sum(1 for v in counts.values() if v == k)) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        raw = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
        return [min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3))]

    def p(order, gram):
        if order == 0:
            return 1 / width
        counts = (one, two, three)[order - 1]
        same = {g: v for g, v in counts.items() if g // width == gram // width}
        below = p(order - 1, gram % width ** (order - 1))
        if not same:
            return below
        d, total = discounts(counts), sum(same.values())
        own = same.get(gram, 0)
        rest = sum(d[min(v, 3) - 1] for v in same.values()) / total
        return (own - (d[min(own, 3) - 1] if own else 0)) / total + rest * below

    ids = [numbers[w] for w in "a b c d e f".split()]
    for x, y, z in itertools.product([0, *ids], ids, ids):
        gram = (x * width + y) * width + z
        assert math.isclose(table[gram], p(3, gram), rel_tol=1e-4), (x, y, z)


def test_bad_text_goes_and_clean_text_stays(spark, documents):
    rows, labels = table()
    rows += [(1000, None, "en", "s"), (1001, " \n", "en", "s"), (1002, good(random.Random(9), 6), "en", "s"), (1003, good(random.Random(1), 30_000), None, "s"),
             (1004, good(random.Random(2)), "xx", "s"), (1005, bad(random.Random(3)), None, "s"), (1002, good(random.Random(9), 6), "en", "s")]
    found = run(spark, documents, rows, labels)
    assert len(found) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert all(not kept[i] for i, good_text, _ in labels if not good_text)
    assert sum(not kept[i] for i, good_text, _ in labels if good_text) <= 2
    assert [kept[i] for i in range(1000, 1006)] == [False, False, True, True, True, False]


def test_nothing_trusted(spark, documents):
    rows = [(1, "some words"), (2, None), (3, "")]
    assert {r["doc_id"]: r["kept"] for r in run(spark, documents, rows, [(1, 0, 0)])} == {1: True, 2: False, 3: False}
    assert run(spark, documents, [], []) == []


def test_every_trusted_word_counts(spark, documents):
    """Well-shaped junk of a small language goes, though its words are far beyond the most frequent of all text."""
    draw = random.Random(14)
    main = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(200)]
    small = ["".join(draw.choices("klmnopqrst", k=6)) for _ in range(60)]
    rows = [(k, " ".join(draw.choices(main, k=80)), "en", "s") for k in range(400)]
    rows += [(1000 + k, " ".join(draw.choices(small, k=80)), "xx", "s") for k in range(80)]
    junk = [(2000 + k, " ".join("".join(draw.choices("klmnopqrst", k=6)) for _ in range(80)), "xx", "s") for k in range(5)]
    clean = [(3000 + k, " ".join(draw.choices(small, k=80)), "xx", "s") for k in range(5)]
    kept = {r["doc_id"]: r["kept"] for r in run(spark, documents, rows + junk + clean, [(i, 1, 0) for i, *_ in rows])}
    assert [kept[i] for i, *_ in junk] == [False] * 5
    assert [kept[i] for i, *_ in clean] == [True] * 5


@pytest.fixture
def folder(monkeypatch, tmp_path):
    """Where written tables go in this test."""
    for owner in (common, module):
        monkeypatch.setattr(owner, "work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}-{random.getrandbits(64):x}", raising=False)
    return tmp_path


def test_no_table_of_ngrams_stays(spark, documents, folder):
    """Only what the result reads is left on disk."""
    rows, labels = table(60)
    assert len(run(spark, documents, rows, labels)) == 60
    left = {file.relative_to(folder).parts[0].rsplit("-", 2)[0] for file in folder.rglob("*.parquet")}
    assert left <= {"perplexities", "limits", "key-filter"}
    assert spark.conf.get(common.SHUFFLES_REMOVED, None) in (None, "false") and not [t for t in spark.catalog.listTables() if t.name.startswith("word_model")]


def test_numbers_packed():
    draw = random.Random(3)
    for values in ([], [0], [5] * 9, sorted(draw.getrandbits(64) for _ in range(500)), [2**64 - 1]):
        for rising in (False, True):
            assert unpacked(packed(np.array(values, np.uint64), rising), rising).tolist() == values


def test_shares_and_slices_by_the_formulas(spark, monkeypatch, folder):
    """Perplexities from the table of word n-grams, counted and looked up share by share, against the formulas on all of them."""
    monkeypatch.setattr(module, "SHARE_CHARS", 1000)
    monkeypatch.setattr(module, "SLICE_CHARS", 2000)
    monkeypatch.setattr(module, "PIECE_DOCS", 7)
    draw = random.Random(12)
    texts = [" ".join(draw.choices("aa b\u00e9 cc dd ee ff gg hh".split(), [20, 9, 5, 4, 3, 2, 1, 1], k=draw.randrange(1, 40))) for _ in range(50)]
    asked = texts + [None, " \u3000", "unseen words here", "aa unseen b\u00e9", "\u3000aa\tcc \n"]
    learned = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    vocabulary, _ = vocabulary_of(learned, 36)
    numbers, width = _Numbers(list(vocabulary)), len(vocabulary)
    below = kneser_ney(learned, vocabulary)
    model = WordModel(learned, f"{folder}/none", vocabulary, (np.zeros(width), {}))
    own = spark.createDataFrame([(k, None, t) for k, t in enumerate(asked)], "id long, lang string, text string")
    found = {int(r["id"]): (r["n"], r["perplexity"]) for r in perplexities(own, model, vocabulary, spark.sparkContext.broadcast(below)).collect()}
    model.remove()

    def spread(text):
        words = (text or "").split()
        return ["", "", *words, ""] if words else []

    three = Counter(tuple(w[k:k + 3]) for w in map(spread, texts) for k in range(len(w) - 2))
    two = Counter(g[1:] for g in three)
    one = Counter(g[1:] for g in two)
    cuts = [module.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in (one, two, three)]

    def probability(gram, least):
        if not gram:
            return least
        counts, cut = (one, two, three)[len(gram) - 1], cuts[len(gram) - 1]
        same = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        lower = probability(gram[1:], least)
        if not same:
            return lower
        n = counts[gram]
        return ((n - cut[min(n, 3) - 1] if n else 0) + sum(cut[min(x, 3) - 1] for x in same) * lower) / sum(same)

    assert len(found) == len(asked)
    for k, text in enumerate(asked):
        words, ids = spread(text), trigrams(text, numbers, width)
        logs = []
        for at, symbol in enumerate(ids):
            kind = vocabulary[symbol % width]
            least = math.exp(below[symbol]) / (len(one) if kind.startswith("~") or kind == module.OTHER else 1)
            logs.append(math.log(probability(tuple(words[at:at + 3]), least)))
        assert found[k][0] == len(logs)
        if logs:
            assert math.isclose(found[k][1], math.exp(-sum(logs) / len(logs)), rel_tol=1e-5), text
        else:
            assert found[k][1] is None


def test_many_words_at_once():
    """Shapes, numbers and hashes of an array of words against those word by word."""
    draw = random.Random(5)
    signs = [*map(chr, range(33, 127)), *"\0\u00e9\u00c9\u00df\u00aa\u01c5\u0661\u00b2\u4e2d\u20ac\u0345\u2160\U0001f600\U00010400\U0001d7ce"]
    words = [*dict.fromkeys(["".join(draw.choices(signs, k=draw.randrange(1, 12))) for _ in range(3000)] + ["a" * k for k in range(1, 99)]
                            + ["b" + "\0" * k for k in range(12)] + ["~a", "the", "<edge>", "<other>"])]
    vocabulary = ("<edge>", "<other>", "~a", "~Aa", "~0-0", "the", "a")
    numbers = _Numbers(list(vocabulary))
    for some in (pa.array(words, pa.large_string()), pa.array(["cut off", *words]).slice(1)):
        assert ["~" + x for x in module.shapes(some).to_pylist()] == [shape(w) for w in words]
        assert module.numbered(some, vocabulary).tolist() == [numbers[w] for w in words]
    hashes = module.hashed(pa.array(words))
    assert len(set(hashes.tolist())) == len(words)
    assert module.hashed(pa.array(words[::-1]).slice(5)).tolist() == hashes[::-1][5:].tolist()
    none = pa.array([], pa.string())
    assert not len(module.shapes(none)) and not len(module.numbered(none, vocabulary)) and not len(module.hashed(none))


def test_numbers_kept_as_codes():
    draw = np.random.default_rng(5)
    for size in (0, 1, 500):
        values = draw.geometric(0.7, (5, size)).astype(np.uint64)
        codes, kinds = module._coded(values)
        assert (kinds[:, codes] == values).all() and len(set(zip(*kinds.tolist()))) == kinds.shape[1]
        keys = module._different(draw.integers(0, 1 << 63, size).astype(np.uint64))
        wanted = [keys[::3], keys[:0], np.append(keys[1::2], np.uint64(2**64 - 1))]
        for found, asked in zip(module._places(keys, wanted), wanted):
            assert [keys[k] if k < len(keys) else None for k in found] == [x if x in keys else None for x in asked]
        for buckets in (1, 7, 32, 65536):
            assert module._cuts(keys, buckets).tolist() == np.searchsorted(module.buckets_of(keys, buckets), np.arange(buckets + 1)).tolist()


def test_texts_are_cut_once(monkeypatch):
    """Keys and scores come from the words found when a piece was made, which holds no text."""
    vocabulary = ("<edge>", "<other>", "~a", "one")
    texts = ["one two two", None, " ", "three\u3000one"] * 3
    rows = pa.record_batch({"id": [str(k) for k in range(len(texts))], "lang": ["en", None, "de", "en"] * 3, "text": pa.array(texts, pa.string())})
    monkeypatch.setattr(module, "PIECE_DOCS", 5)
    pieces = [*module._pieces([rows, rows.slice(0, 0), rows.slice(3)], vocabulary)]
    assert [i for x in pieces for i in x.column("ids")[0].as_py()] == [str(k) for k in [*range(12), *range(3, 12)]]
    assert [len(x.column("ids")[0]) for x in pieces] == [5, 5, 5, 5, 1]
    monkeypatch.setattr(module, "Words", None)
    for piece in pieces:
        asked = pa.Table.from_batches(module._asked([piece], 4))
        empty = pa.table({name: pa.array([], pa.binary()) for name in module.MODEL})
        answers = pa.concat_tables(module._answers(asked.slice(k, 1), empty) for k in range(len(asked)))
        table = type("Shared", (), {"value": np.full(len(vocabulary)**3, math.log(0.25), np.float32)})
        found = module._scored(pa.Table.from_batches([piece]), answers, vocabulary, table, 1.0, 1, 1.0, [[0.5, 0.5, 0.5]] * 3).to_pylist()
        assert [r["n"] for r in found] == [{"one two two": 4, "three\u3000one": 3}.get(texts[int(r["id"])], 0) for r in found]
        assert all(math.isclose(r["perplexity"], 4, rel_tol=1e-6) if r["n"] else r["perplexity"] is None for r in found)
