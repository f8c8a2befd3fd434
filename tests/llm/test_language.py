from __future__ import annotations

import random
import zlib

import numpy as np

from spendscore.llm import language
from spendscore.llm.language import Model, languages, parser, suffix_automaton


def text(words, draw, n=80):
    return " ".join(draw.choices(words, k=n))


WORDS = {
    "en": ["the", "house", "with", "and", "thing", "over", "which"],
    "de": ["der", "und", "schon", "häuser", "über", "nicht", "straße"],
    "fr": ["le", "maison", "très", "où", "avec", "être", "chez"],
}


def labelled(n=40):
    draw = random.Random(5)
    return [(k, text(WORDS[lang], draw), lang, "s") for k, lang in enumerate(list(WORDS) * n)]


def test_automaton_knows_all_substrings():
    draw = random.Random(1)
    sample = [draw.randrange(3) for _ in range(60)]
    table = suffix_automaton(sample, 4)
    inside = {tuple(sample[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for _ in range(500):
        word = tuple(draw.randrange(4) for _ in range(draw.randrange(1, 7)))
        state = 0
        for sign in word:
            state = table[state, sign] if state or sign == word[0] else 0
            if not state:
                break
        assert bool(state) == (word in inside)


def phrases(sample, word):
    """Longest matches, one after the other."""
    inside = {tuple(sample[i:j]) for i in range(len(sample)) for j in range(i + 1, len(sample) + 1)}
    count = at = 0
    while at < len(word):
        end = at + 1
        while end < len(word) and tuple(word[at : end + 1]) in inside:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_by_brute_force(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 25)
    draw = random.Random(2)
    model = Model({"a": "abab cab bca", "b": "ccc bbb acb"})
    texts = ["", "abc", "zzz", "abc cab zab " * 9, "a" * 100] + ["".join(draw.choices("abc z", k=70)) for _ in range(20)]
    signs = [model.read(t)[0] for t in texts]
    found = model.phrases(signs)
    for column, name in enumerate(model.languages):
        sample = model.read({"a": "abab cab bca", "b": "ccc bbb acb"}[name])[0].tolist()
        expected = [sum(phrases(sample, s.tolist()[i : i + 25]) for i in range(0, len(s), 25)) for s in signs]
        assert found[:, column].tolist() == expected


def test_parser_keeps_state_on_the_filler():
    table = parser(suffix_automaton([0, 1, 0], 2))
    assert (table[:, 2] == 4 * np.arange(len(table))).all()


def test_languages(documents):
    rows = labelled() + [(1000, None, "en", "s"), (1001, "12 ... 34!", "en", "s"), (1002, "", None, "s"), (1003, "𝐀𝐁", "en", "s"),
                         (1004, "the house " * 30_000, None, "s"), (1005, "x", None, "s"), (0, rows_text := "nicht über", "fr", "s"), (0, rows_text, "fr", "s")]
    found = languages(documents(*rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == lang for i, t, lang, _ in labelled() if i)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {i: by_id[i]["lang_pred"] for i in (1000, 1001, 1002)} == {1000: "und", 1001: "und", 1002: "und"}
    assert by_id[1003]["lang_pred"] in WORDS and by_id[1004]["lang_pred"] == "en"


def test_no_use_of_held_out_labels(documents):
    """Wrong languages of held-out rows change nothing."""
    rows = labelled()
    wrong = [(i, t, "fr" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    first, second = ({tuple(r) for r in languages(documents(*x)).collect()} for x in (rows, wrong))
    assert first == second


def test_nothing_learned(documents):
    assert {r["lang_pred"] for r in languages(documents((1, "some words", None, "s"))).collect()} == {"und"}
    assert languages(documents()).collect() == []


def test_ties_go_to_the_first_name():
    assert Model({"b": "aa bb", "a": "aa bb"}).predict(["aa bb"])[0][0] == "a"


def test_scripts_beyond_the_alphabet_are_told_apart(spark, documents):
    """Two languages of hundreds of signs each beside a large Latin one, none of whose signs is among the most frequent."""
    draw = random.Random(8)
    signs = {"aa": [chr(0x4E00 + 7 * k) for k in range(400)], "bb": [chr(0xAC00 + 5 * k) for k in range(400)], "cc": [chr(0x20000 + 3 * k) for k in range(400)]}
    words = {lang: ["".join(draw.choices(own, k=draw.randint(1, 3))) for _ in range(30)] for lang, own in signs.items()}
    words["en"] = WORDS["en"] + [f"{a}{b}" for a in "abcdefghijklmnopqrstuvwxyzàâäçéèêëîïôöùûüÿñß" for b in "aeiou"]
    rows = [(k, text(words[lang], draw, 60), lang, "s") for k, lang in enumerate(sorted(words) * 30)]
    found = languages(documents(*rows)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in found)
