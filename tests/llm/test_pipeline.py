"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from holdfast.llm import contamination, jaccard, mixing, queries, secret_scan
from oracle_check import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="no test tables")


def test_license_query_has_the_same_rows_in_sql(spark):
    got = queries.QUERIES["op1_license_scan"](spark, SF_DIR).toPandas()
    want = connect(SF_DIR).execute(queries.ORACLES["op1_license_scan"]).df()
    for frame in (got, want):
        frame[["first_word", "last_word"]] = frame[["first_word", "last_word"]].astype("float64")
    assert compare(got, want) == ""


@pytest.mark.parametrize("name", sorted(set(queries.ORACLES) - {"op1_license_scan"}))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(got, connect(SF_DIR).execute(queries.ORACLES[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_returns_every_row(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    source = {"op4": "embeddings", "op6": "pages"}.get(name.split("_")[0], "documents")
    if name not in ("op8_secret_scan", "op3_language_id"):
        assert rows.count() == spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
    else:
        assert rows.count() > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("*", "doc_id AS size", "text AS taken")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mix"]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, SF_DIR), name)
        if name != "mix":
            assert out.columns == docs.columns and out.count() <= docs.count()
        docs, before = out, docs
        if name == "near_duplicates":
            assert jaccard.jaccard_components(out).where("doc_id <> component_id").count() == 0
        elif name == "decontamination":
            assert contamination.contamination(out, bench).where("contaminated").count() == 0
        elif name == "secrets":
            assert out.count() == before.count() and secret_scan.findings(out).where("is_secret").count() == 0
        elif name == "mix":
            sizes = mixing.mixed(before).agg({"taken": "sum"}).first()[0]
            assert out.agg({"mix_taken": "sum"}).first()[0] == sizes and out.where("mix_taken <= 0").count() == 0


def test_stages_accept_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, "en", "s", None), (3, "w " * 50_000, None, "s", 1), (3, "w " * 50_000, None, "s", 1), (4, "one two three four five six", "en", "t", 2)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            assert corpus_pipeline.staged(stage(spark, docs, SF_DIR), name).count() <= docs.count()
