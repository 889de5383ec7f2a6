"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic steps.

The features approximate a Gaussian kernel over standardised statistics. Every partition sums its part of
the normal equations, per fold; the folds' sums give out-of-fold scores for the calibration and, all
together, the final weights. What reaches the driver is a matrix and a histogram of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACED, Texts, lists, mix, prefix_hashes, span_hashes, text_chunks, words_of
from holdfast.session import staged

N_FEATURES = 160  # random Fourier features
WIDTH = 4.0  # of the Gaussian kernel, over standardised statistics
RIDGE = 3e-3  # per labelled row
GRID = 1000  # steps a unit of raw score in the calibration's histogram
SEED = 20
ACCEPT = 0.7
FOLDS = 4  # of the documents, by checksum of the id; HELD_OUT is never trained on
HELD_OUT = 2

_byte = np.arange(256)
_CLASSES = {
    "letter": ((_byte >= 97) & (_byte <= 122)) | ((_byte >= 65) & (_byte <= 90)) | (_byte >= 128),
    "upper": (_byte >= 65) & (_byte <= 90),
    "digit": (_byte >= 48) & (_byte <= 57),
    "stop": np.isin(_byte, list(b".,;:?")),
    "shout": _byte == ord("!"),
    "bar": _byte == ord("|"),
    "symbol": np.isin(_byte, list(b"#$%&*@^~<>{}[]\\/_=+`")),
    "line": _byte == 10,
}
STATISTICS = [
    "log_words", "word_length", "letters", "uppers", "digits", "stops", "shouts", "bars", "symbols", "distinct_words",
    "repeated_lines", "log_line", "letterless_words", "common_word",
]


def statistics(texts: Texts) -> np.ndarray:
    """One row of STATISTICS per text; an empty text has zeros throughout.

    Text classes are counted on whole texts; shares are of bytes, words or lines.
    """
    data, first = texts.data, texts.first
    size = np.maximum(np.diff(first) - 1, 0).astype(float)
    per = np.maximum(size, 1)

    def count(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (sums[first[1:] - 1] - sums[first[:-1]]).astype(float)

    n = {name: count(kind) for name, kind in _CLASSES.items()}
    words = words_of(texts, SPACED)
    n_words = np.diff(words.first).astype(float)
    per_word = np.maximum(n_words, 1)
    letters = np.concatenate([[0], np.cumsum(_CLASSES["letter"][data], dtype=np.int64)])
    bare = np.bincount(words.text[letters[words.ends] == letters[words.starts]], minlength=len(texts)).astype(float)
    keys = mix(words.hashes + words.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, where, counts = np.unique(keys, return_index=True, return_counts=True)
    distinct = np.bincount(words.text[where], minlength=len(texts)).astype(float)
    most = np.zeros(len(texts))
    np.maximum.at(most, words.text[where], counts)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    of_text = np.searchsorted(first, starts, side="right") - 1
    full = ends > starts
    starts, ends, of_text = starts[full], ends[full], of_text[full]
    lines = mix(span_hashes(prefix_hashes(data), starts, ends) + of_text.astype(np.uint64))
    _, where = np.unique(lines, return_index=True)
    n_lines = np.bincount(of_text, minlength=len(texts)).astype(float)
    repeated = 1 - np.bincount(of_text[where], minlength=len(texts)) / np.maximum(n_lines, 1)
    out = np.column_stack([
        np.log1p(n_words), np.minimum((words.ends - words.starts).sum() and np.bincount(words.text, words.ends - words.starts, len(texts)) / per_word, 100.0),
        n["letter"] / per, n["upper"] / np.maximum(n["letter"], 1), n["digit"] / per, n["stop"] / per_word, n["shout"] / per_word, n["bar"] / per_word,
        n["symbol"] / per_word, np.where(n_words > 0, distinct / np.maximum(n_words, 1) ** 0.8, 0), np.where(n_lines > 0, repeated, 0),
        np.log1p(size / np.maximum(n_lines, 1)), bare / per_word, most / per_word,
    ])
    out[size == 0] = 0
    return out


def statistics_of(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(STATISTICS))), *(statistics(c) for c in text_chunks(column))])


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(x.ravel(), np.full(len(x), x.shape[1]))], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    """Scores statistics; without labelled rows there is nothing against a document and its score is 1."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    steps: np.ndarray | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        omega = rng.standard_normal((x.shape[1], N_FEATURES)) / WIDTH
        phase = rng.uniform(0, 2 * np.pi, N_FEATURES)
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ omega + phase) * np.sqrt(2 / N_FEATURES)
        return np.column_stack([np.ones(len(x)), z])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return np.interp(self.features(x) @ self.weights, self.knots, self.steps)


def isotonic(at: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools neighbours until the means rise; knots and values for linear interpolation."""
    pools: list[list[float]] = []
    for a, w, t in zip(at, weight, total):
        pools.append([a * w, w, t])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    penalty = np.eye(len(gram)) * RIDGE * max(gram[0, 0], 1)
    penalty[0, 0] = 1e-9
    return np.linalg.solve(gram + penalty, right)


def fold(doc_id: str = "doc_id") -> Column:
    """Checksum of the id as text, modulo the folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """Learns from described documents (doc_id, x) with a non-null label outside the held-out fold.

    Several labels of one document count as their mean; labels of unknown documents are ignored.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    rows = staged(described.withColumn("fold", fold()).where(f"fold <> {HELD_OUT}").join(known, "doc_id").select("fold", "x", "y"), "labelled")
    d = len(STATISTICS)
    sums = rows.select(F.count("*"), *(F.avg(F.col("x")[i]) for i in range(d)), *(F.stddev_pop(F.col("x")[i]) for i in range(d))).first()
    if not sums[0]:
        return Model()
    model = Model(np.array(sums[1 : d + 1], float), np.maximum(np.array(sums[d + 1 :], float), 1e-6))
    wide = N_FEATURES + 1

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((FOLDS, wide, wide + 1))
        for batch in batches:
            if len(batch):
                z = model.features(np.stack(batch.x.to_numpy()))
                y, f = batch.y.to_numpy(), batch.fold.to_numpy()
                for k in np.unique(f):
                    own = f == k
                    held[k] += np.column_stack([z[own].T @ z[own], z[own].T @ y[own]])
        for k in np.flatnonzero(held[:, 0, 0]):
            yield pd.DataFrame({"k": k, "i": np.arange(wide), "v": list(held[k])})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": part.k[:1], "i": part.i[:1], "v": [np.sum(np.stack(part.v.to_numpy()), axis=0)]})

    schema = "k long, i long, v array<double>"
    parts = np.zeros((FOLDS, wide, wide + 1))
    for r in rows.mapInPandas(sum_up, schema).groupBy("k", "i").applyInPandas(add, schema).collect():
        parts[r.k, r.i] = r.v
    whole = parts.sum(axis=0)
    model.weights = _solve(whole[:, :wide], whole[:, wide])
    others = {}
    for k in range(FOLDS):
        rest = whole - parts[k]
        others[k] = _solve(rest[:, :wide], rest[:, wide]) if rest[0, 0] else model.weights

    def out_of_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                z, f = model.features(np.stack(batch.x.to_numpy())), batch.fold.to_numpy()
                raw = np.einsum("ij,ij->i", z, np.stack([others[k] for k in f]))
                yield pd.DataFrame({"at": np.clip(np.round(raw * GRID), -GRID, 2 * GRID).astype(int), "y": batch.y})

    bins = rows.mapInPandas(out_of_fold, "at long, y double").groupBy("at").agg(F.count("*").alias("w"), F.sum("y").alias("t")).orderBy("at").collect()
    model.knots, model.steps = isotonic(np.array([b.at / GRID for b in bins]), np.array([b.w for b in bins], float), np.array([b.t for b in bins], float))
    return model


def scored(described: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every described document, empty ones too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["score"] = np.clip(model.score(np.stack(batch.x.to_numpy())), 0, 1)
                yield batch[["doc_id", "held_out", "score"]]

    kind = described.schema["doc_id"].dataType.simpleString()
    rows = described.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "x")
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", F.expr(f"CAST(score >= {ACCEPT} AS int)"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score reaches ACCEPT, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics_of(batch.column(at))) >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)
