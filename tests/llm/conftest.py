from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves, with such as need quoting.
CLASHES = ("id", "n", "cls", "words", "hash", "doc", "mark", "score", "kept", "block", "component_id", "item", "root", "src", "tokens",
           "a.b", "__gone", "__again", "__word", "__bits", "__cut_doc", "__cut_mark", "__cuts", "__mix_src", "__mix_full", "__n_cut", "__WORD_")


@pytest.fixture
def documents(spark):
    """Make documents from (id, text[, lang[, source]]), with columns whose names operators may use themselves."""

    def make(*rows):
        full = [(*row, "en", "src")[:4] if len(row) < 4 else row for row in rows]
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in full]
        df = spark.createDataFrame(full, DOCUMENT)
        return df.selectExpr("*", *[f"'clash' AS `{name}`" for name in CLASHES])

    return make
