"""From documents to a training mix: quality, near duplicates, benchmark passages, secrets, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import contamination, jaccard, mixing, quality, secret_scan
from holdfast.llm.common import small_batches, table
from holdfast.llm.links import few
from holdfast.session import staged


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    small_batches(spark)
    model = quality.fit(staged(quality.with_statistics(docs), "described"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    small_batches(spark)
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without verbatim benchmark passages."""
    small_batches(spark)
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return secret_scan.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken (repeats counted) and their source's target."""
    picked = mixing.mixed(docs).where("taken > 0").groupBy("doc_id", "size").agg(F.max("taken").alias("taken"), F.max("target").alias("target"))
    picked = staged(picked.toDF("mix_id", "mix_size", "mix_taken", "mix_target"), "picked")
    same = docs["doc_id"].eqNullSafe(picked["mix_id"]) & (mixing.n_words(docs["text"]) == picked["mix_size"])
    return docs.join(few(picked), same).select(*[docs[c] for c in docs.columns], "mix_taken", "mix_target")


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# Trained models and connected components have no SQL form; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
