"""Removal of repeated byte strings by grouping suffixes per block, with a cover sample.

Only suffixes that can tie for `LENGTH` bytes are ever grouped. The cover is a sample of positions such that
every string of LENGTH bytes holds one of them, and equal strings hold it at the same place: the smallest
hash of any `GRAM` bytes in the string. (A cover by residues has that property for pairs of positions only
and samples three times as many.) The sampled grams are counted first, over all texts; a gram
that only one text has rules out all suffixes it covers. The other suffixes fall into buckets by the gram
that covers them. Buckets are read one after the other, in streams ordered by bucket and document, and suffixes
are grouped by 64-bit names of LENGTH bytes, whose bytes are then compared; grams get no ranks and
suffixes no order. Buckets with very many suffixes are cut further, by the name itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import Texts, prefix_hashes, release, short_shuffles, span_hashes, text_chunks
from holdfast.llm.links import few
from holdfast.session import staged

LENGTH = 50  # bytes of a repeated string
GRAM = 16  # bytes of a cover position's gram
REACH = LENGTH - GRAM + 1  # grams in a string of LENGTH bytes
CROWD = 20_000  # suffix groups from which a bucket is cut by name

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def cover(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, first and last string start it covers) of the cover positions, ascending.

    Strings never cross texts. Of equal hashes the leftmost counts, so equal strings choose alike.
    """
    n = len(texts.data)
    if n < LENGTH:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    at = np.arange(n - GRAM + 1)
    names = span_hashes(prefix_hashes(texts.data), at, at + GRAM)
    lowest = names.copy()  # minimum over the next `have` grams
    have = 1
    while have < REACH:
        step = min(have, REACH - have)
        lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
        have += step
    starts = np.arange(len(lowest))
    inside = np.zeros(len(lowest), dtype=bool)
    for a, b in zip(texts.first[:-1].tolist(), texts.first[1:].tolist()):
        inside[a : max(a, b - LENGTH)] = True  # b counts the separator
    # the leftmost gram with the lowest name: the next place of that name at or after the start
    chosen = _next_place(names, lowest, starts)[inside]
    starts = starts[inside]
    if not len(starts):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(starts) != 1)]))
    ends = np.append(fresh[1:], len(chosen)) - 1
    return chosen[fresh], names[chosen[fresh]], starts[fresh], starts[ends]


def _next_place(names: np.ndarray, lowest: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each start the first place at or after it whose name is the lowest of its reach."""
    # a new minimum enters at the right end, or the old one leaves at the left: places change only there
    change = np.flatnonzero(np.concatenate([[True], lowest[1:] != lowest[:-1]]))
    place = np.empty(len(lowest), dtype=np.int64)
    lengths = np.diff(np.append(change, len(lowest)))
    window = names[np.minimum(change[:, None] + np.arange(REACH)[None, :], len(names) - 1)]
    place[change] = change + np.argmax(window == lowest[change][:, None], axis=1)
    out = np.repeat(place[change], lengths)
    # the same minimum twice in a row (repeated text): move on when the first place is passed
    late = np.flatnonzero(out < starts)
    for i in late.tolist():
        p = out[i - 1] if out[i - 1] >= i else -1
        out[i] = p if p >= 0 else i + int(np.argmax(names[i : i + REACH] == lowest[i]))
    return out


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for chunk in text_chunks(batch.column(1)):
            _, names, first, _ = cover(chunk)
            text = np.searchsorted(chunk.first, first, side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(ids[chunk.rows][text]), pa.array(first - chunk.first[text])], names=["gram", "doc", "start"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gram, doc, start), sorted, to those whose gram two documents have. Holds back no more than the
    places of one gram in one document."""
    held = None  # rows of the last gram, as long as one document has it; or the gram, once two have
    settled = None
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(3)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        gram, doc, _ = cols
        if not len(gram):
            continue
        starts = np.flatnonzero(np.concatenate([[True], np.diff(gram) != 0]))
        lengths = np.diff(np.append(starts, len(gram)))
        last = starts + lengths - 1
        several = doc[starts] != doc[last]
        if settled is not None and gram[0] == settled:
            several[0] = True
        settled = gram[-1] if several[-1] else None
        keep = np.repeat(several, lengths)
        held = None
        if not several[-1]:
            held = [x[starts[-1] :] for x in cols]
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in cols], names=["gram", "doc", "start"])


def _suffix_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, starts, crowded) to suffix groups (bucket, doc, start, body): the bytes of all strings
    that one cover position covers; in crowded buckets one string each."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for chunk in text_chunks(batch.column(1)):
            _, names, first, last = cover(chunk)
            text = np.searchsorted(chunk.first, first, side="right") - 1
            local = first - chunk.first[text]
            flag = np.zeros(len(first), dtype=np.int8)
            bounds = np.searchsorted(text, np.arange(len(chunk) + 1))
            for i in range(len(chunk)):
                own = slice(bounds[i], bounds[i + 1])
                for value, column in ((1, 2), (2, 3)):
                    wanted = batch.column(column)[chunk.rows.start + i].values
                    if wanted is not None and len(wanted):
                        flag[own][np.isin(local[own], wanted.to_numpy())] = value
            whole = np.flatnonzero(flag == 1)
            begin, end, bucket = first[whole], last[whole] + LENGTH, names[whole]
            split = np.flatnonzero(flag == 2)
            counts = last[split] - first[split] + 1
            each = np.repeat(first[split], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            sums = prefix_hashes(chunk.data)
            begin, end = np.concatenate([begin, each]), np.concatenate([end, each + LENGTH])
            bucket = np.concatenate([bucket, span_hashes(sums, each, each + LENGTH)])
            owner = np.searchsorted(chunk.first, begin, side="right") - 1
            data = chunk.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket.view(np.int64)), pa.array(ids[chunk.rows][owner]), pa.array(begin - chunk.first[owner]),
                    pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                ],
                names=["bucket", "doc", "start", "body"],
            )


def _equal_groups(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, head): the strings that begin there with equal ones together, else in the order given, and for
    each ordered string the first of its group.

    Hashes bring equal strings together and the bytes are compared, eight at a time; where two unlike
    strings share a hash, the strings themselves are sorted instead.
    """
    words = np.ndarray(len(data) - 7, dtype=np.uint64, buffer=data, strides=(1,))
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    keys = span_hashes(prefix_hashes(data), begin, begin + LENGTH)
    while True:
        order = np.argsort(keys, kind="stable")
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = np.diff(keys[order]) != 0
        head = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        later = np.flatnonzero(~fresh)
        one, other = begin[order[later]], begin[order[later - 1]]
        if all((words[one + i] == words[other + i]).all() for i in steps):
            return order, head
        strings = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begin]
        keys = np.unique(strings, axis=0, return_inverse=True)[1].reshape(-1)


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix groups ordered by bucket and document to (doc, low, high): starts of strings that a smaller
    document has. Equal strings are in one bucket. Of the last bucket only the strings seen and their smallest
    document are carried on."""
    carried: tuple[int, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        bucket, doc, start = (batch.column(i).to_numpy() for i in range(3))
        body = batch.column(3).cast(pa.large_binary())
        offsets = np.frombuffer(body.buffers()[1], dtype=np.int64)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        counts = np.diff(offsets) - LENGTH + 1
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin, owner, in_last = offsets[row] + place, doc[row], bucket[row] == bucket[-1]
        own = 0  # strings carried, before those of the batch
        if carried is not None and carried[0] == bucket[0]:
            own = len(carried[2])
            begin = np.concatenate([np.arange(own) * LENGTH, begin + own * LENGTH])
            data = np.concatenate([carried[1].reshape(-1), data])
            owner = np.concatenate([carried[2], owner])
            in_last = np.concatenate([np.full(own, bucket[0] == bucket[-1]), in_last])
        order, head = _equal_groups(data, begin)
        least = np.empty(len(order), dtype=owner.dtype)
        least[order] = owner[order[head]]
        last = order[np.unique(head[in_last[order]])]
        carried = (int(bucket[-1]), np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begin[last]], owner[last])
        again = least[own:] < owner[own:]
        edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
        new_row = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
        rises = np.union1d(np.flatnonzero(edge == 1), new_row[again[new_row]])
        falls = np.union1d(np.flatnonzero(edge == -1), new_row[1:][again[new_row[1:] - 1]])
        r = row[rises]
        yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(start[r] + place[rises]), pa.array(start[r] + place[falls - 1])], names=["doc", "low", "high"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, lows, highs) to what is left of the text, as digest columns."""
    for batch in batches:
        texts, lows, highs = (batch.column(i).to_pylist() for i in (1, 2, 3))
        out = []
        for text, low, high in zip(texts, lows, highs):
            data = (text or "").encode()
            kept, at, removed, spans = [], 0, 0, 0
            end = 0  # of the removed run
            for a, b in sorted(zip(low or [], high or [])):
                b += LENGTH
                if a > end or not spans:
                    kept.append(data[end:a] if spans else data[:a])
                    spans += 1
                    removed += b - a
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            kept.append(data[end:] if spans else data)
            out.append((len(data), removed, spans, hashlib.sha256(b"".join(kept)).hexdigest()))
        cols = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(doc, low, high): starts of strings of LENGTH bytes that also start in a smaller document.

    `docs` has doc (integer, not null) and text; texts that others repeat whole should not be in it.
    """
    spark = docs.sparkSession
    rows = docs.mapInArrow(_grams, "gram long, doc long, start long").repartition("gram").sortWithinPartitions("gram", "doc")
    shared = staged(rows.mapInArrow(_shared, "gram long, doc long, start long"), "shared")
    crowds = staged(shared.groupBy("gram").count().where(f"count >= {CROWD}").select("gram", F.lit(True).alias("crowded")), "crowds")
    marked = shared.join(few(crowds), "gram", "left").groupBy("doc")
    starts = marked.agg(F.expr("collect_list(CASE WHEN crowded IS NULL THEN start END)").alias("starts"), F.expr("collect_list(CASE WHEN crowded THEN start END)").alias("crowded"))
    starts = staged(starts, "starts")
    release(spark, shared, crowds)
    texts = docs.join(few(starts.select("doc")), "doc", "left_semi").join(starts, "doc").select("doc", "text", "starts", "crowded")
    groups = texts.mapInArrow(_suffix_groups, "bucket long, doc long, start long, body binary")
    groups = groups.repartition("bucket").sortWithinPartitions("bucket", "doc")
    return groups.mapInArrow(_sorted_buckets, "doc long, low long, high long")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs and the digest of the rest.

    A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id.
    Null texts are empty; a document without id keeps everything and takes from none. A text that a smaller
    document has whole goes altogether if it has LENGTH bytes; only first holders are searched.
    """
    short_shuffles(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digests = staged(named.where("doc_id IS NOT NULL").select("doc_id", F.md5("text").alias("digest"), F.octet_length("text").alias("n")), "digests")
    holders = digests.where(f"n >= {LENGTH}").groupBy("digest").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last")).where("holder < last")
    copies = staged(digests.join(holders, "digest").where("doc_id > holder").select("doc_id", F.lit(True).alias("copy")).distinct(), "copies")
    searched = named.where(f"doc_id IS NOT NULL AND octet_length(text) >= {LENGTH}").join(few(copies), "doc_id", "left_anti")
    found = repeated_starts(searched.withColumnRenamed("doc_id", "doc"))
    runs = found.groupBy("doc").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    runs = staged(runs.withColumnRenamed("doc", "doc_id"), "repeats")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    hit = named.join(few(runs.select("doc_id")), "doc_id", "left_semi").join(runs, "doc_id").select("doc_id", "text", "lows", "highs")
    plain = named.join(few(runs.select("doc_id")), "doc_id", "left_anti").join(few(copies), "doc_id", "left")
    whole = F.expr(f"coalesce(copy, false) AND octet_length(text) >= {LENGTH}")
    plain = plain.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.when(whole, F.octet_length("text")).otherwise(0).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"), F.sha2(F.when(whole, F.lit("")).otherwise(F.col("text")).cast("binary"), 256).alias("kept_sha256"),
    )
    return hit.mapInArrow(_cut, schema).unionByName(plain)
