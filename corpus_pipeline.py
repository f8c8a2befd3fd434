"""From raw documents to a mixed training corpus, stage by stage.

Every stage reads what its predecessor has written, so a lost executor or driver costs
one stage at most, and each works on all that the one before has kept.

Rows that share a ``doc_id`` are kept or dropped together, but exact repeats of a row's id and
text become one. Rows without ``doc_id`` can't be told apart: the stages that drop
documents keep them. All columns of ``documents`` are carried along, further ones too;
``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.llm.common import table, unused, written
from spendscore.llm.decontaminate import contaminated
from spendscore.llm.filters import split_by_keys
from spendscore.llm.language import UNDETERMINED, judged_languages
from spendscore.llm.line_windows import line_windows
from spendscore.llm.mixing import mixed_sources
from spendscore.llm.ngram_join import ngram_join

#: A narrow margin between two learned languages is no reason to drop a text.
LEAST_SCORE = 0.0
#: A text is in none of the languages if the winner's bits a character, less one phrase's, are more than this many times
#: those that the winner's labelled texts take.
MOST_BITS = 2.0


def _without(docs: DataFrame, ids: DataFrame, purpose: str) -> DataFrame:
    """``docs`` without those of ``ids``; texts that can't be meant are not shuffled."""
    (of_gone,) = unused(docs, "__gone")
    gone = written(ids.where("doc_id IS NOT NULL").select(F.col("doc_id").alias(of_gone)).distinct(), purpose)
    may, can_not = split_by_keys(docs, gone, F.xxhash64("doc_id"), F.xxhash64(of_gone))
    return may.join(gone, F.col("doc_id") == F.col(of_gone), "left_anti").unionByName(can_not)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, and such as even the best language explains far worse than its labelled texts.

    NULL and empty texts have no letter and go, unless they have no id: those stay. Texts of any length are parsed whole; of languages
    equally near the first by name decides. Repeated rows go or stay together. An empty table gives none; extra columns stay.
    """
    found = judged_languages(docs)
    far = F.col("excess") > MOST_BITS * F.col("typical")
    return _without(docs, found.where((F.col("lang_pred") == UNDETERMINED) | far), "no-language")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated three-line windows; documents of which nothing is left go.

    NULL texts, empty ones and such of one or two lines of any length are left as they are. Equal windows are told apart by id and
    place, so the first of tied ones stays; rows with equal id and text are cut alike. An empty table gives none; extra columns stay.
    """
    n_lines, n_cut = unused(docs, "__n_lines", "__n_cut")
    cut = line_windows(docs, counts=(n_lines, n_cut))
    left = cut.where((F.col(n_cut) == 0) | (F.trim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col(n_cut) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return left.drop(n_lines, n_cut)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8.

    NULL and wordless texts are alone and stay, as do rows without id. Whole texts are compared, of any length. Rows that tie for the
    smallest id are one if their texts are equal, else all stay. An empty table gives none; extra columns stay.
    """
    (of_again,) = unused(docs, "__again")
    found = written(ngram_join(docs, length=5, percent=80), "groups")
    kept = _without(docs, found.where("doc_id <> component_id"), "near-duplicates")
    repeated = written(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                       .select(F.col("doc_id").alias(of_again)), "repeated-ids")
    again = F.col("doc_id") == F.col(of_again)
    return kept.join(repeated, again, "left_anti").unionByName(
        kept.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item.

    NULL and empty texts hold none and stay, rows without id too. Texts of any length are searched whole; repeated rows go or stay together,
    and it doesn't matter which of tied passages is found. Without items all stay; an empty table gives none; extra columns stay.
    """
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")), "contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, drawn by tempered source weights; a row per document and block.

    NULL and wordless texts have no tokens and aren't drawn; a NULL source is a source. A text of any length is drawn whole or not at
    all. Repeated rows, and rows without id, tie for a place and are drawn together. An empty table gives none; extra columns stay.
    """
    return mixed_sources(docs, entropy=0.97, repeats=4.0, budget=1.0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language identification", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
]

#: Language identification by cross-parsing can't be said in SQL; the tests hold the
#: stages against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is read from what the last one has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
