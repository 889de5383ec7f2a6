"""The registered queries: each operator, with its production settings, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import centroids, contamination, jaccard, language, licenses, mixing, pages, phrases, quality, secret_scan, suffixes, vectors, warc
from holdfast.llm.common import table
from holdfast.session import staged

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = staged(quality.with_statistics(table(spark, sf_dir, "documents")), "described")
    return quality.scored(described, quality.fit(described, table(spark, sf_dir, "labels")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (trained on three quarters of them) and pages; `kind` says which, the other's id is null."""
    documents = table(spark, sf_dir, "documents")
    model = language.learned(documents.where(quality.fold() != quality.HELD_OUT))
    rows = language.document_rows(documents).withColumns({"page_id": F.lit(None).cast("long"), "url": F.lit(None).cast("string"), "kind": F.lit("document")})
    found = language.page_rows(table(spark, sf_dir, "pages")).withColumns({"doc_id": F.lit(None).cast("long"), "kind": F.lit("page")})
    return language.identified(rows.unionByName(found), ["kind", "doc_id", "page_id", "url"], model)


def op4_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extracted(table(spark, sf_dir, "pages"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(table(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    op1_license_scan, op2_quality_classifier, op3_language_id, op4_vector_near_duplicates, op5_mix_sources,
    op6_html_extraction, op7_ngram_jaccard_join, op8_secret_scan, op9_suffix_array_dedup, op10_decontamination, op11_centroid_clustering, op12_warc,
    op13_phrase_collocations,
]}
ORACLES: dict[str, str] = {"op1_license_scan": licenses.oracle(), "op11_centroid_clustering": centroids.oracle(), "op12_warc": warc.oracle(), "op13_phrase_collocations": phrases.oracle()}
