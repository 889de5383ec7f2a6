"""Helpers the operators share: tables, row batches, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word of the two word rules, for JVM regular expressions (text lower-cased in A-Z first).
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of text handled at a time inside a task.
CHUNK_BYTES = 250_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

_bytes = np.arange(256)
_LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)
SPACED = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python in batches of at most so many rows from now on, which bounds what both sides hold."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def short_shuffles(spark: SparkSession) -> None:
    """From now on Spark deletes the shuffle files of an action when it ends; lost ones are made again from staged frames."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def release(spark: SparkSession, *done: DataFrame) -> None:
    """Gives disk back: deletes staged frames that nothing reads any more, and lets Spark delete the shuffle files of
    finished jobs now; it does so when the driver's JVM collects their plans."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for df in done for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()


def lowered(text: Column) -> Column:
    """The text with A-Z (and nothing else) in lower case; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept between calls."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums from which `span_hashes` reads the hash of any byte range."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _power("up", _BASE, n), dtype=np.uint64, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end): equal bytes, equal hash."""
    turned = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(sums))[starts]
    return mix(turned + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


@dataclass
class Texts:
    """Whole texts laid end to end as UTF-8 bytes, one separator (a line feed) after each."""

    data: np.ndarray
    first: np.ndarray  # start of each text, and the end of all
    rows: slice  # the rows of the batch

    def __len__(self) -> int:
        return len(self.first) - 1


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of about `most` bytes, never cut inside a text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, n)
        sizes = np.diff(offsets[at : to + 1])
        first = np.zeros(to - at + 1, dtype=np.int64)
        np.cumsum(sizes + 1, out=first[1:])
        laid = np.full(first[-1], 10, dtype=np.uint8)
        keep = np.ones(first[-1], dtype=bool)
        keep[first[1:] - 1] = False
        laid[keep] = data[offsets[at] : offsets[to]]
        yield Texts(laid, first, slice(at, to))
        at = to


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # number of words before each text, and of all
    text: np.ndarray  # index of the text of each word


def words_of(texts: Texts, kind: np.ndarray) -> Words:
    """Words (maximal runs of bytes of `kind`) of the texts, lower-cased in A-Z.

    Both word rules exclude the separator, so no word crosses two texts.
    """
    data = _LOWER[texts.data]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = kind[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(starts, texts.first)
    counts = np.diff(first)
    return Words(starts, ends, span_hashes(prefix_hashes(data), starts, ends), first, np.repeat(np.arange(len(counts)), counts))


def int_array(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list column out of all values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
