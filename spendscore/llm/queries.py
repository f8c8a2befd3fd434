"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendscore.llm.common import table
from spendscore.llm.decontaminate import contaminated
from spendscore.llm.hard_negatives import hard_negatives
from spendscore.llm.html_main import main_texts
from spendscore.llm.language import languages
from spendscore.llm.licenses import license_scan
from spendscore.llm.line_windows import line_windows
from spendscore.llm.mixing import mixed_sources
from spendscore.llm.near_vectors import near_vectors
from spendscore.llm.ngram_join import ngram_join
from spendscore.llm.oracle import ORACLE  # noqa: F401  the SQL beside the queries
from spendscore.llm.quality import quality
from spendscore.llm.toxicity import toxicity
from spendscore.llm.warc import round_trip
from spendscore.llm.whitening import whitened


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), length=3, percent=90)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_cut")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixed_sources(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "source", "n_tokens", "block", "place")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(rows, anchors=F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_ngram_jaccard_join, op3_warc, op4_language_id, op5_line_dedup, op6_toxicity,
        op7_quality_classifier, op8_benchmark_decontamination, op9_mixing, op10_license_scan, op11_embedding_whitening, op12_html_extraction,
        op13_hard_negatives,
    )
}
