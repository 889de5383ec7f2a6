"""Language identification by fusing evidence.

A row's languages are weighed by four sources: the likelihood of its text under character trigrams, the
language its markup declares, the suffix of its address, and a prior of its host. The trigram counts are
learned from documents with a known language. The other three are learned from all rows, by grouped counts
of the language their text alone speaks for; a host's counts are smoothed by its domain's, and those by the
counts of all rows. A row's own vote is taken out of its host's and domain's counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import LOWER, UPPER, Texts, lists, text_chunks
from holdfast.session import staged

BUCKETS = 1 << 13  # of hashed trigrams
MOST_LANGUAGES = 500  # the model's size is BUCKETS numbers per language
SMOOTH = 0.5  # added to every trigram count
HOST_WEIGHT = 5.0  # rows that a wider level counts for at a narrower one
EVIDENCE_WEIGHT = 1.0  # added to the counts of declared languages and suffixes

_byte = np.arange(256)
_FOLD = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, np.where(((_byte >= 97) & (_byte <= 122)) | (_byte >= 128), _byte, 32)).astype(np.uint32)


def _trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams with a letter in the middle, and the text each belongs to."""
    data = _FOLD[texts.data]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    where = np.flatnonzero(data[1:-1] != 32)
    code = code[where].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 13)
    return code.astype(np.int64), np.searchsorted(texts.first, where + 1, side="right") - 1


def learned(documents: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, np.ndarray]:
    """Log probabilities of the trigram buckets per language, from all rows with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for chunk in text_chunks(batch.column(1)):
                code, text_of = _trigrams(chunk)
                own = np.array(names[chunk.rows], dtype=object)
                for name in set(own):
                    mine = np.flatnonzero(own == name)
                    held.setdefault(name, np.zeros(BUCKETS, np.int64))
                    held[name] += np.bincount(code[np.isin(text_of, mine)], minlength=BUCKETS)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held)), lists(np.concatenate(list(held.values())), np.full(len(held), BUCKETS))], names=["lang", "n"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": part.lang[:1], "n": [np.sum(np.stack(part.n.to_numpy()), axis=0)]})

    rows = documents.where(F.col(lang).isNotNull()).select(lang, text).mapInArrow(count, "lang string, n array<long>")
    sums = rows.groupBy("lang").applyInPandas(add, "lang string, n array<long>").orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(sums) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r.lang: np.log((np.array(r.n) + SMOOTH) / (sum(r.n) + SMOOTH * BUCKETS)) for r in sums}


def _spoken(rows: DataFrame, keys: list[str], model: dict[str, np.ndarray]) -> DataFrame:
    """`keys` and `text_score`, the tempered log likelihood of the text in each language.

    Trigrams of one text are not independent: n of them count as the square root of n.
    """
    names = list(model)
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros((0, len(names)))]
            for chunk in text_chunks(batch.column(n_keys)):
                code, text_of = _trigrams(chunk)
                n = np.bincount(text_of, minlength=len(chunk))
                scores = np.stack([np.bincount(text_of, model[name][code], minlength=len(chunk)) for name in names], axis=1) if names else np.zeros((len(chunk), 0))
                out.append(scores / np.sqrt(np.maximum(n, 1))[:, None])
            scores = np.concatenate(out)
            arrays = [*batch.columns[:n_keys], lists(scores.ravel(), np.full(len(scores), len(names)))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "text_score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)
    return rows.select(*keys, "text").mapInArrow(run, f"{schema}, text_score array<double>")


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as rows for `identified`: visible text, declared language, host."""
    return pages.select(
        "page_id", "url",
        F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z0-9#]+;", " ").alias("text"),
        F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)).alias("declared"),
        F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)).alias("host"),
    )


def identified(rows: DataFrame, keys: list[str], model: dict[str, np.ndarray]) -> DataFrame:
    """`keys`, lang, probability, text_lang and declared of every row.

    `rows` has the keys, text, declared and host; null or empty values give no evidence. A text without
    letters leaves the decision to the other sources; ties go to the first language by code point.
    Without any language learned, lang is null. Repeated rows are judged alike.
    """
    names = list(model)
    if not names:
        return rows.select(*keys, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("text_lang"), "declared")
    listed = F.array(*[F.lit(n) for n in names])
    clean = rows.select(*keys, "text", F.nullif(F.col("declared"), F.lit("")).alias("declared"), F.nullif(F.col("host"), F.lit("")).alias("host"))
    spoken = _spoken(clean, [*keys, "declared", "host"], model)
    numeric = F.col("host").rlike(r"^[0-9.]+$") | ~F.contains("host", F.lit("."))
    spoken = spoken.withColumn("suffix", F.when(~numeric, F.substring_index("host", ".", -1)))
    spoken = spoken.withColumn("domain", F.when(numeric, F.col("host")).otherwise(F.substring_index("host", ".", -2)))
    best: Column = F.array_position("text_score", F.array_max("text_score")).cast("int")
    spoken = spoken.withColumn("text_lang", F.when(F.array_max("text_score") != F.array_min("text_score"), F.element_at(listed, best)))
    spoken = staged(spoken, "spoken")

    def counted(level: str) -> DataFrame:
        """level, its number of rows that speak a language, and how many speak each."""
        rows = spoken.where(F.col(level).isNotNull() & F.col("text_lang").isNotNull()).groupBy(level)
        each = [F.count(F.when(F.col("text_lang") == n, 1)).cast("double") for n in names]
        return rows.agg(F.array(*each).alias(f"n_{level}"))

    total = spoken.agg(F.array(*[F.count(F.when(F.col("text_lang") == n, 1)).cast("double") for n in names])).first()[0]
    share = (np.array(total) + 1) / (sum(total) + len(names))
    out = spoken
    for level in ("declared", "suffix", "domain", "host"):
        out = out.join(counted(level), level, "left")
    zero = F.array(*[F.lit(0.0)] * len(names))
    mine = F.transform(listed, lambda n: F.when(n == F.col("text_lang"), 1.0).otherwise(0.0))
    others = lambda level: F.zip_with(F.coalesce(f"n_{level}", zero), mine, lambda a, b: F.greatest(a - F.when(F.col(level).isNotNull(), F.coalesce(b, F.lit(0.0))).otherwise(0.0), F.lit(0.0)))
    summed = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)

    def smoothed(level: str, prior: Column) -> Column:
        n = others(level)
        return F.zip_with(n, prior, lambda a, p: (a + HOST_WEIGHT * p) / (summed(n) + HOST_WEIGHT))

    out = out.withColumn("domain_prior", smoothed("domain", F.array(*[F.lit(float(s)) for s in share])))
    out = out.withColumn("host_prior", smoothed("host", F.col("domain_prior")))
    # P(value | language) for declared languages and suffixes, from the value's counts
    base = F.array(*[F.lit(float(t) + EVIDENCE_WEIGHT * 20) for t in total])
    likely = lambda level: F.zip_with(F.coalesce(f"n_{level}", zero), base, lambda a, t: F.when(F.col(level).isNull(), 0.0).otherwise(F.log((a + EVIDENCE_WEIGHT) / t)))
    score = F.zip_with("text_score", F.transform("host_prior", lambda p: F.log(p)), lambda a, b: a + b)
    score = F.zip_with(F.zip_with(score, likely("declared"), lambda a, b: a + b), likely("suffix"), lambda a, b: a + b)
    out = out.withColumn("score", score).withColumn("top", F.array_max("score"))
    weight = F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("top")))
    return out.select(*keys, F.element_at(listed, F.array_position("score", F.col("top")).cast("int")).alias("lang"), (1 / weight).alias("probability"), "text_lang", "declared")


def document_rows(documents: DataFrame) -> DataFrame:
    """Documents as rows for `identified`: no markup, the source stands for the host."""
    return documents.select("doc_id", "text", F.lit(None).cast("string").alias("declared"), F.translate("source", UPPER, LOWER).alias("host"))
