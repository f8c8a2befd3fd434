"""The pipeline, stage by stage, against plain Python on a small corpus."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from spendscore.llm.language import languages
from tests.llm.test_decontaminate import brute as passages
from tests.llm.test_line_windows import brute as line_cuts
from tests.llm.test_mixing import brute as mixture
from tests.llm.test_ngram_join import brute as groups

WORDS = {
    "en": "the house with and thing over which under water stone road apple river".split(),
    "de": "der und schon häuser über nicht straße wasser stein apfel fluss weg".split(),
}
PASSAGE = "every benchmark question has one right answer that nobody may read before the test begins today"


def corpus():
    draw = random.Random(11)
    rows = []
    for k in range(60):
        lang = "en" if k % 3 else "de"
        lines = [" ".join(draw.choices(WORDS[lang], k=12)) for _ in range(5)]
        rows.append((k, "\n".join(lines), lang, f"s{k % 4 if k % 5 else 0}"))
    rows += [(100 + k, rows[k][1], rows[k][2], "s1") for k in range(5)]  # copies
    rows += [(110 + k, rows[k][1].replace("\n", " ") + " x", rows[k][2], "s1") for k in range(5)]  # near copies on one line
    shared = "\n".join(" ".join(draw.choices(WORDS["en"], k=9)) for _ in range(4))
    rows += [(120 + k, f"{' '.join(draw.choices(WORDS['en'], k=20))}\n{shared}\n{' '.join(draw.choices(WORDS['en'], k=20))}", "en", "s2") for k in range(3)]
    rows += [(130, f"the house {PASSAGE} and over", "en", "s3"), (131, PASSAGE.replace("question", "water"), "en", "s3"), (132, "123 456", "en", "s3"),
             (133, None, "en", "s3"), (134, "", "de", "s3"), (3, rows[3][1], rows[3][2], rows[3][3])]
    return rows


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in corpus()]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{folder}/documents.parquet")
    spark.createDataFrame([(7, PASSAGE)], "item_id long, text string").write.parquet(f"file://{folder}/benchmark.parquet")
    return f"file://{folder}"


def simple(df):
    return sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    rows = simple(docs)
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, sf_dir), "test")
        if name == "language identification":
            # The prediction itself is held against plain parsing in test_language.
            gone = {r["doc_id"] for r in languages(docs).collect() if r["lang_pred"] == "und" or r["score"] < corpus_pipeline.LEAST_SCORE}
            assert gone == {132, 133, 134}
            expected = [r for r in rows if r[0] not in gone]
        elif name == "line dedup":
            cut = {i: (text, n) for i, text, _, n in line_cuts(list({(r[0] if r[0] else 0, r[1]) for r in rows}))}
            cut = {(0 if i == -1 else i): x for i, x in cut.items()}
            expected = [(r[0], cut[r[0]][0], *r[2:]) for r in rows if cut[r[0]][1] == "0" or cut[r[0]][0].strip()]
            assert {r[0] for r in expected} == {r[0] for r in rows} - {100, 101, 102, 103, 104}
        elif name == "n-gram Jaccard join":
            least = {(0 if i == -1 else i): (0 if c == -1 else c) for i, _, c in groups([(r[0], r[1]) for r in rows], 5, 80)}
            expected = sorted({r for r in rows if least[r[0]] == r[0]}, key=str)
            assert not {110, 111, 112, 113, 114} & {r[0] for r in expected}
        elif name == "benchmark decontamination":
            leaks = {d for d, *_ in passages([(r[0], r[1]) for r in rows], [(7, PASSAGE)])}
            assert leaks == {130, 131}
            expected = [r for r in rows if r[0] not in leaks]
        else:
            drawn = mixture(rows, 0.97, 4.0, 1.0)[1]
            assert sorted(((r["doc_id"], r["source"], r["n_tokens"], r["block"], r["place"]) for r in out.collect()), key=str) == drawn
            assert set(columns) < set(out.columns)
            return
        assert simple(out) == sorted(expected, key=str), name
        assert out.columns == columns and all(r["n_chars"] == len(r["text"]) for r in out.collect())
        docs, rows = out, sorted(expected, key=str)


def test_run(spark, sf_dir):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.count() > 30 and not {100, 110, 130, 131, 132, 133} & {r["doc_id"] for r in found.select("doc_id").collect()}


def test_empty_and_clashing(spark, documents, sf_dir):
    for docs in (documents(), documents((1, "the house", "en", "s"), (None, "the house", None, None), (2, None, None, None))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert sorted(out.columns) == sorted(docs.columns)
            docs = corpus_pipeline.written(out, "test")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 0


def test_split_label_keeps_its_texts(spark, documents):
    """One language under two labels stays whole; text in none of the learned languages goes."""
    draw = random.Random(12)
    rows = [(k, " ".join(draw.choices(WORDS[lang], k=80)), ("en", "en-US")[k // 2 % 2] if lang == "en" else "de", "s")
            for k, lang in enumerate(["en", "de"] * 60)]
    foreign = [(1000 + k, " ".join("".join(draw.choices("qxzjkvbwyp", k=6)) for _ in range(40)), None, "s") for k in range(5)]
    short = [(2000, "The house", None, "s"), (2001, "an", None, "s")]
    found = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, documents(*rows, *foreign, *short), "").collect()}
    assert found == {r[0] for r in rows + short}
