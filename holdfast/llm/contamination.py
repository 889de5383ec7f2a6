"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each task turns the texts it scans into shards. Words become numbers of the test items' vocabulary;
a suffix of a training text can only hold a test window if its words are all known, so the suffix array
of a shard is built over such suffixes alone, ordered by their first `DEPTH` words. Every suffix of the
test items is then searched in it by bisection. Hits on one diagonal join into longest verbatim matches.
Nothing is shuffled; the test items are read in blocks of a fixed number of words, so that what a task
holds does not grow with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdfast.llm.common import ALNUM, text_chunks, words_of
from holdfast.session import staged

WINDOW = 10
# Words by which suffixes are ordered; at least the window.
DEPTH = 16
# Words of test items that one pass over the texts searches for.
BLOCK_WORDS = 2_000_000

FOUND = "array<struct<item_id: bigint, item_start: int, doc_start: int, n_words: int>>"
_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())]))


@dataclass
class Tests:
    """A block of test items: their words as numbers, and their windows as fixed-width keys."""

    vocabulary: np.ndarray  # sorted word hashes
    names: list[int | None]  # id of each item
    item: np.ndarray  # item of each window
    at: np.ndarray  # start of each window in its item
    low: np.ndarray  # smallest key that begins with the window
    high: np.ndarray  # largest
    length: np.ndarray  # words of each window
    least: int  # words of the shortest window

    @classmethod
    def of(cls, items: list[tuple[int | None, str | None]]) -> Tests | None:
        chunk = next(text_chunks(pa.array([t for _, t in items], pa.string()), 1 << 60), None)
        words = words_of(chunk, ALNUM) if chunk else None
        if words is None or not len(words.hashes):
            return None
        vocabulary = np.unique(words.hashes)
        numbers = (np.searchsorted(vocabulary, words.hashes) + 1).astype(np.uint32)
        counts = np.diff(words.first)
        lengths = np.minimum(counts, WINDOW)
        windows = np.where(counts > 0, counts - lengths + 1, 0)
        item = np.repeat(np.arange(len(counts)), windows)
        at = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        start, length = words.first[item] + at, lengths[item]
        inside = np.arange(DEPTH)[None, :] < length[:, None]
        body = numbers[np.minimum(start[:, None] + np.arange(DEPTH)[None, :], len(numbers) - 1)]
        low = np.where(inside, body, 0).astype(">u4")
        high = np.where(inside, body, 0xFFFFFFFF).astype(">u4")
        return cls(vocabulary, [i for i, _ in items], item, at, _keys(low), _keys(high), length, int(lengths[counts > 0].min()))


def _keys(numbers: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which compare like the rows."""
    return np.ascontiguousarray(numbers).view(f"S{4 * DEPTH}").ravel()


def shard_matches(words, tests: Tests) -> np.ndarray:
    """Hits (window, position) of the test windows in a shard, positions counted in its words."""
    if not len(words.hashes):
        return np.zeros((0, 2), dtype=np.int64)
    place = np.minimum(np.searchsorted(tests.vocabulary, words.hashes), len(tests.vocabulary) - 1)
    numbers = np.where(tests.vocabulary[place] == words.hashes, place + 1, 0).astype(np.uint32)
    n = len(numbers)
    # where the run of known words that a word stands in ends; a text's last word ends its run
    stop = np.where(numbers == 0, np.arange(n), n)
    last = words.first[1:][np.diff(words.first) > 0] - 1
    ends = np.minimum.accumulate(stop[::-1])[::-1]
    of_text = np.repeat(last + 1, np.diff(words.first)[np.diff(words.first) > 0])
    run = np.minimum(ends, of_text) - np.arange(n)
    suffixes = np.flatnonzero(run >= tests.least)
    if not len(suffixes):
        return np.zeros((0, 2), dtype=np.int64)
    inside = np.arange(DEPTH)[None, :] < run[suffixes][:, None]
    body = numbers[np.minimum(suffixes[:, None] + np.arange(DEPTH)[None, :], n - 1)]
    keys = _keys(np.where(inside, body, 0).astype(">u4"))
    order = np.argsort(keys, kind="stable")
    keys, suffixes = keys[order], suffixes[order]
    lower, upper = np.searchsorted(keys, tests.low, side="left"), np.searchsorted(keys, tests.high, side="right")
    counts = np.maximum(upper - lower, 0)
    window = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts)
    position = suffixes[np.repeat(lower, counts) + offset]
    return np.column_stack([window, position])


def longest_matches(hits: np.ndarray, words, tests: Tests) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start in the item, start in the text, words): runs of hits on one diagonal."""
    if not len(hits):
        return []
    text = words.text[hits[:, 1]]
    place = hits[:, 1] - words.first[text]
    at, item = tests.at[hits[:, 0]], tests.item[hits[:, 0]]
    length = tests.length[hits[:, 0]]
    order = np.lexsort((at, place - at, item, text))
    text, place, at, item, length = (x[order] for x in (text, place, at, item, length))
    new = np.ones(len(text), dtype=bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(place - at) != 0) | (np.diff(at) > 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(text)) - 1
    return list(zip(text[starts].tolist(), item[starts].tolist(), at[starts].tolist(), place[starts].tolist(), (at[ends] + length[ends] - at[starts]).tolist()))


def _found(column: pa.Array, tests: Tests) -> tuple[list[list[dict]], list[int]]:
    """The matches and the number of words of each text of a column."""
    found: list[list[dict]] = [[] for _ in range(len(column))]
    totals: list[int] = []
    for chunk in text_chunks(column):
        words = words_of(chunk, ALNUM)
        totals += np.diff(words.first).tolist()
        for text, item, at, place, n in longest_matches(shard_matches(words, tests), words, tests):
            found[chunk.rows.start + text].append({"item_id": tests.names[item], "item_start": at, "doc_start": place, "n_words": n})
    return found, totals


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Tests]:
    """The test items in blocks of a bounded number of words, fetched one partition at a time.

    An item without id is searched but has no name.
    """
    held: list[tuple[int | None, str | None]] = []
    size = 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1]) // 2 + 1
        if size >= block_words:
            if (tests := Tests.of(held)) is not None:
                yield tests
            held, size = [], 0
    if held and (tests := Tests.of(held)) is not None:
        yield tests


def with_matches(docs: DataFrame, benchmark: DataFrame, found: str = "found", words: str = "n_words", block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` (with a column `text`) and two more columns: its longest verbatim matches with test items,
    and its number of words.

    Null and empty texts have no words and no matches. An item of fewer than ten words matches as a whole.
    Rows are judged one by one, so repeated rows get equal results; other columns pass through untouched.
    """
    schema = T.StructType(list(docs.schema.fields)).add(found, T._parse_datatype_string(FOUND)).add(words, "long")
    n_before, at = len(docs.columns), docs.columns.index("text")
    names = schema.fieldNames()

    def search(tests: Tests | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(at)
                if tests is None:
                    hits, totals = [[] for _ in range(len(batch))], []
                    for chunk in text_chunks(column):
                        totals += np.diff(words_of(chunk, ALNUM).first).tolist()
                else:
                    hits, totals = _found(column, tests)
                if batch.num_columns > n_before:
                    hits = [a + b for a, b in zip(batch.column(n_before).to_pylist(), hits)]
                arrays = [*batch.columns[:n_before], pa.array(hits, _FOUND), pa.array(totals, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

        return run

    out, done = docs, 0
    for tests in blocks_of(benchmark, block_words):
        out = (staged(out, "searched") if done else out).mapInArrow(search(tests), schema)
        done += 1
    return out if done else docs.mapInArrow(search(None), schema)


def _hit_words(found: list[dict]) -> int:
    n, end = 0, 0
    for start, stop in sorted((m["doc_start"], m["doc_start"] + m["n_words"]) for m in found):
        n += max(0, stop - max(start, end))
        end = max(end, stop)
    return n


SUMMARY = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match int"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, words inside test windows, items found and whether it is contaminated."""
    searched = with_matches(docs.select("doc_id", "text"), benchmark).drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found").to_pylist()
            items = [sorted({str(m["item_id"]) for m in f if m["item_id"] is not None}) for f in found]
            hit = [_hit_words(f) for f in found]
            arrays = [
                batch.column("doc_id"), batch.column("n_words"), pa.array(hit, pa.int64()), pa.array([len(i) for i in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                pa.array([n > 0 for n in hit], pa.bool_()), pa.array([max((m["n_words"] for m in f), default=0) for f in found], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match"])

    return searched.mapInArrow(run, SUMMARY)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any match, all columns kept as they are."""
    name = "_found"
    while name in docs.columns:
        name += "_"
    searched = with_matches(docs, benchmark, name, name + "n")
    return searched.where(f"size(`{name}`) = 0").drop(name, name + "n")
