"""N-gram Jaccard join with partition-and-enumerate signatures.

A document is the set of its distinct five-word shingles. Sets of one size band that are similar enough
differ in few shingles, so after a partition of the shingle domain some combination of parts is equal in
both; the hash of such a combination is a signature, and similar sets share one.

* Sets below `FIRST_BAND` use the finest partition, one part per shingle: signatures are the combinations of
  two or three shingles out of the smallest-hashed ones. This loses nothing.
* Larger sets use bands of doubling size. `plan` picks, per band, the number of parts, of sub-parts and of
  sub-parts left out, such that a pair at exactly the threshold shares no signature with probability below
  e^-`MISS`; pairs above it are safer still.

Sets that share a signature are candidates. Copies of one set are a single candidate. In each signature's
run, all sets are compared to the run's head, the set that shares most signatures with others (in a group of
edited copies the least edited one); after the components of these links are known, only runs
that still hold several components are compared further, between components, in blocks. A parity sketch of
the sets bounds their difference from below and discards unlike pairs; what passes is verified on the whole
shingle sets. Rounds go on until no unverified pair is left, so no link between different texts is lost and
no group is expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import SPACED, Texts, lists, mix, text_chunks, words_of
from holdfast.llm.links import components, few, light
from holdfast.session import staged

WORDS = 5  # of a shingle
OVER, UNDER = 75, 100  # similarity: UNDER * |both| >= OVER * |either|
FIRST_BAND = 64
THREE = 24  # sets up to this size use combinations of three shingles, up to FIRST_BAND of two
MISS = 21.0
BITS = 8  # of a sketch, per shingle at the lower end of the band
LEAST_BITS = BITS * FIRST_BAND
BLOCK = 6000  # sets of a run that one task compares with as many others
P, Q = UNDER + OVER, UNDER - OVER  # sets are linked if P * |difference| <= Q * (sum of sizes)
PER_PAIR = 200  # closest pairs verified in one round between two components of a block

_U = np.uint64
_MULTIPLIERS = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | _U(1)


def shingles(texts: Texts) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than WORDS make one shingle, none make none."""
    words = words_of(texts, SPACED)
    h, n = words.hashes, len(words.hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(WORDS):
        rolled[: n - i] += h[i:] * _MULTIPLIERS[i]
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(rolled[a : b - WORDS + 1]))
        else:
            short = (h[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + _U(b - a)) if b > a else short[:0])
    return out


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """Number of shingles that only one of two sets has."""
    return len(a) + len(b) - 2 * len(np.intersect1d(a, b, assume_unique=True))


@cache
def plan(low: int) -> tuple[int, int, int]:
    """Parts, sub-parts and sub-parts left out for the band whose smaller sets have [low, 2 low) shingles.

    A pair at the threshold with a + b shingles differs in (a + b) / 7 and shares 3 (a + b) / 7 of them. A
    part serves if at most `out` of its differing shingles exist and a shared one lies in the sub-parts kept.
    """
    best = None
    for out, subs in [(0, 1), (1, 2), (1, 3), (2, 3), (2, 4)]:
        parts = 2
        while True:
            enough = True
            for total in (2 * low, low * 14 // 3):
                differ, shared = total / 7, 3 * total / 7
                serves = sum(
                    math.exp(math.lgamma(differ + 1) - math.lgamma(d + 1) - math.lgamma(differ - d + 1) - d * math.log(parts) + (differ - d) * math.log1p(-1 / parts))
                    * (1 - (1 - (1 - d / subs) / parts) ** shared)
                    for d in range(out + 1)
                )
                enough &= -parts * math.log1p(-min(serves, 1 - 1e-12)) >= MISS
            if enough or parts > 8 * low:
                break
            parts = max(parts + 1, int(parts * 1.02))
        cost = parts * math.comb(subs, out)
        if enough and (best is None or cost < best[0]):
            best = (cost, parts, subs, out)
    return best[1:] if best else (8 * low, 1, 0)


def _bands(n: int) -> list[int]:
    """Bands a set belongs to: the one of its size, and the one below if a partner may be there."""
    home = FIRST_BAND << max(0, (n // FIRST_BAND).bit_length() - 1)
    out = [home] if n >= FIRST_BAND else []
    if n >= FIRST_BAND and home > FIRST_BAND and OVER * n < UNDER * home:
        out.append(home // 2)
    return out


def _combined(prefix: np.ndarray, take: int) -> np.ndarray:
    """Signatures of all combinations of `take` shingles out of a prefix."""
    which = np.array(list(combinations(range(len(prefix)), take)), dtype=np.int64).reshape(-1, take)
    return mix(mix(prefix)[which].sum(axis=1, dtype=np.uint64) + _U(take))


def _partitioned(s: np.ndarray, low: int) -> np.ndarray:
    parts, subs, out = plan(low)
    spread = mix(s + _U(low))
    cell = (spread % _U(parts)).astype(np.int64) * subs + ((spread >> _U(40)) % _U(subs)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(cell) != 0]))
    sums = np.zeros(parts * subs, dtype=np.uint64)
    sums[cell[starts]] = np.add.reduceat(mix(s)[order], starts)
    table = sums.reshape(parts, subs)
    tag = mix(np.arange(parts, dtype=np.uint64) * _U(1_000_003) + _U(low))
    found = []
    for kept in combinations(range(subs), subs - out):
        total = table[:, kept].sum(axis=1, dtype=np.uint64)
        own = (table[:, kept] != 0).any(axis=1)
        found.append(mix(total + tag + _U(sum(1 << i for i in kept)))[own])
    return np.concatenate(found)


def signatures(s: np.ndarray) -> np.ndarray:
    """Signatures of a sorted set of shingle hashes. Sets below three shingles are only similar to copies."""
    n = len(s)
    found = []
    if 3 <= n and OVER * n <= UNDER * THREE:
        found.append(_combined(s[: n - (OVER * n + UNDER - 1) // UNDER + 3], 3))
    if n > THREE and OVER * n <= UNDER * (FIRST_BAND - 1):
        found.append(_combined(s[: n - (OVER * n + UNDER - 1) // UNDER + 2], 2))
    found += [_partitioned(s, low) for low in _bands(n)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def sketch(s: np.ndarray) -> bytes:
    """Parities of the shingles per hash bucket, `BITS` buckets per shingle of the band's lower end."""
    bits = BITS * _bands(len(s))[0] if len(s) >= FIRST_BAND else LEAST_BITS
    return np.packbits(np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").astype(np.uint8).tobytes()


def _fold(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches brought to one size: a parity over fewer buckets is the sum of parities."""
    out = np.zeros((len(sketches), size // 8), dtype=np.uint64)
    for i, x in enumerate(sketches):
        bits = np.frombuffer(x, dtype=np.uint64)
        while len(bits) > size // 8:
            half = len(bits) // 2
            bits = bits[:half] ^ bits[half:]
        out[i] = bits
    return out


def may_differ(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Most shingles in which two similar sets of these sizes differ."""
    return (sizes_a + sizes_b) * Q // P


def described(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_shingles, the set's hash (two words), its sketch and its signatures; one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                sets = shingles(chunk)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                keys = np.array([[s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)] for s in sets], dtype=np.uint64).reshape(-1, 2)
                signed = [signatures(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.rows.start, len(sets)), pa.array(sizes), pa.array(mix(keys[:, 0] + sizes.astype(np.uint64)).view(np.int64)),
                        pa.array(keys[:, 1].view(np.int64)), pa.array([sketch(s) for s in sets], pa.binary()),
                        lists(np.concatenate(signed).view(np.int64) if signed else np.zeros(0, np.int64), np.array([len(x) for x in signed], dtype=np.int64)),
                    ],
                    names=["id", "n_shingles", "key", "also", "sketch", "signatures"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"id {kind}, n_shingles long, key long, also long, sketch binary, signatures array<long>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (signature, key), sorted, to the rows of signatures that several keys share, each with
    its place in the run. Streams: only one batch and the end of the last are held."""
    held: tuple[int, int, int] | None = None  # signature, last key, place of the last key
    for batch in batches:
        s, k = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(s):
            continue
        if held:
            s, k = np.concatenate([[held[0]], s]), np.concatenate([[held[1]], k])
        fresh = np.ones(len(s), dtype=bool)
        fresh[1:] = (np.diff(s) != 0) | (np.diff(k) != 0)
        s, k = s[fresh], k[fresh]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(s) != 0]))
        lengths = np.diff(np.append(starts, len(s)))
        place = np.arange(len(s)) - np.repeat(starts, lengths)
        if held:  # the first run goes on from the batch before; its first row was given out then, if place > 0
            place[: lengths[0]] += held[2]
        several = np.repeat(lengths > 1, lengths)
        several[: lengths[0]] |= place[lengths[0] - 1] > 0
        if held and held[2] > 0:
            several[0] = False
        held = (int(s[-1]), int(k[-1]), int(place[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(x[several]) for x in (s, k, place)], names=["signature", "key", "place"])


def _verified(pairs: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(a, b, differ, linked) of pairs of documents, decided on their whole shingle sets."""
    n = pairs.count()
    ids = staged(light(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), n), "ids")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(few(ids), "id", "left_semi")
    left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sets = [[s for chunk in text_chunks(part.column(i)) for s in shingles(chunk)] for i in (2, 3)]
                differ = np.array([difference(a, b) for a, b in zip(*sets)], dtype=np.int64)
                linked = differ <= may_differ(*(np.array([len(s) for s in side], dtype=np.int64) for side in sets))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(differ), pa.array(linked)], names=["a", "b", "differ", "linked"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    judged = joined.mapInArrow(run, "a long, b long, differ long, linked boolean").groupBy("a", "b")
    return light(judged.agg(F.min("differ").alias("differ"), F.max("linked").alias("linked")), n)


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with `apart`, a lower bound of their difference from sketches and sizes."""
    for batch in batches:
        apart = []
        n_a, n_b = (np.asarray(batch.column(i)) for i in (4, 5))
        for x, y, least in zip(batch.column(6).to_pylist(), batch.column(7).to_pylist(), np.abs(n_a - n_b).tolist()):
            both = _fold([x, y], min(len(x), len(y)))
            apart.append(max(least, int(np.bitwise_count(both[0] ^ both[1]).sum())))
        close = np.array(apart, dtype=np.int64) <= may_differ(n_a, n_b)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(apart, pa.int64()), pa.array(close)], names=["first", "key", "a", "b", "apart", "close"])


def _across(table: pa.Table) -> pa.Table:
    """Closest pairs of each two components in a block, as far as sketches and earlier answers allow; `more`
    if there are too many for one round."""
    ids, comps, sizes, blocks = (table.column(c).to_numpy() for c in ("id", "component", "n_shingles", "block"))
    sketches = table.column("sketch").to_pylist()
    signature, one, two = (table.column(c)[0].as_py() for c in ("signature", "one", "two"))
    denied = {(i, j) for i, d in zip(ids.tolist(), table.column("denied").to_pylist()) for j in d or ()}
    lengths = np.array([len(x) for x in sketches])
    place = np.arange(len(ids))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for size in np.unique(lengths):  # two sets are compared at the smaller of their sketches' sizes
        own = place[lengths >= size]
        folded = _fold([sketches[i] for i in own], int(size))
        left = np.flatnonzero(blocks[own] == one)
        right = np.flatnonzero(blocks[own] == two)
        step = max(1, 4_000_000 // max(1, len(right) * folded.shape[1]))
        for k in range(0, len(left), step):
            x, y = left[k : k + step, None], right[None, :]
            i, j = own[x], own[y]
            near = np.bitwise_count(folded[x] ^ folded[y]).sum(axis=2) <= may_differ(sizes[i], sizes[j])
            near &= (comps[i] != comps[j]) & (np.minimum(lengths[i], lengths[j]) == size)
            near &= UNDER * np.minimum(sizes[i], sizes[j]) >= OVER * np.maximum(sizes[i], sizes[j])
            if one == two:
                near &= i < j
            rows, cols = np.nonzero(near)
            rows, cols = left[k + rows], right[cols]
            apart = np.bitwise_count(folded[rows] ^ folded[cols]).sum(axis=1).tolist()
            for i, j, d in zip(own[rows].tolist(), own[cols].tolist(), apart):
                a, b = sorted((int(ids[i]), int(ids[j])))
                if (a, b) not in denied:
                    held = found.setdefault(tuple(sorted((int(comps[i]), int(comps[j])))), [])
                    held.append((d, a, b))
                    if len(held) > 4 * PER_PAIR:
                        held[:] = sorted(held)[: PER_PAIR + 1]
    pairs = [(signature, *both, a, b, len(held) > PER_PAIR) for both, held in found.items() for _, a, b in sorted(held)[:PER_PAIR]]
    columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in range(5)]
    return pa.table([*columns, pa.array([p[5] for p in pairs], pa.bool_())], names=["signature", "x", "y", "a", "b", "more"])


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of `docs`.

    Null and empty texts have no shingles and stand alone. Rows that repeat a text share a component. Rows of
    one id but different texts are taken as one document with several sets. A row without id gets the
    component of its set, if that has an id anywhere. Ids are integers.
    Links inside a component are not all found: this gives components, not the pairs of the join.
    """
    sets = staged(described(docs, id_column, text).withColumn("id", F.col("id").cast("long")), "sets")
    distinct = sets.where("n_shingles > 0").groupBy("key", "also").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    documents = sets.count()
    distinct = staged(light(distinct.where("id IS NOT NULL"), documents), "distinct")
    rows = sets.select(F.explode("signatures").alias("signature"), "key").repartition("signature").sortWithinPartitions("signature", "key")
    runs = staged(rows.mapInArrow(_runs, "signature long, key long, place long"), "runs")
    # the head of a run is the set that shares most signatures
    shared = runs.groupBy("key").agg(F.count("*").alias("shared"))
    heads = runs.join(shared, "key").groupBy("signature").agg(F.max(F.struct("shared", "key"))["key"].alias("first"))
    members_of_runs = runs.count()
    runs = staged(light(runs.join(heads, "signature"), members_of_runs), "led")

    known = distinct.select("key", "id", "n_shingles", "sketch")
    side = lambda x: known.toDF(f"key_{x}", x, f"n_{x}", f"sketch_{x}")
    stars = runs.where("key <> first").select("first", "key").distinct()
    stars = stars.join(side("a").withColumnRenamed("key_a", "first"), "first").join(side("b").withColumnRenamed("key_b", "key"), "key").where("a <> b")
    stars = stars.selectExpr("first", "key", "least(a, b) AS a", "greatest(a, b) AS b", "n_a", "n_b", "sketch_a", "sketch_b")
    stars = staged(stars.mapInArrow(_apart, "first long, key long, a long, b long, apart long, close boolean"), "stars")
    answers = staged(_verified(stars.where("close").select("a", "b").distinct(), docs, id_column, text), "answers")
    # how far each set of a run is from the run's head: exactly, or at least
    from_first = stars.join(answers, ["a", "b"], "left").selectExpr("first", "key", "coalesce(differ, apart) AS apart", "coalesce(linked, false) AS direct")
    more = True
    while True:
        linked = components(answers.where("linked").select("a", "b"))
        at = known.drop("sketch").join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        at = staged(light(at, documents), "members")
        if not more:
            break
        # By the triangle inequality a set x that is not linked to the head f is not linked to a set y that is if
        # P |f x| - Q |x| > P |f y| + Q |y|, as x and y are linked if P |x y| <= Q (|x| + |y|).
        near = runs.join(at.select("key", "id", "n_shingles", "component"), "key").join(from_first, ["first", "key"], "left")
        direct = "(key = first OR coalesce(direct, false))"
        near = near.selectExpr("signature", "key", "place", "id", "component", f"{direct} AS direct", f"{P} * coalesce(apart, 0) + CASE WHEN {direct} THEN {Q} ELSE -{Q} END * n_shingles AS reach")
        near = staged(light(near, members_of_runs), "near")
        asked = near.groupBy("signature").agg(F.expr("min(CASE WHEN NOT direct THEN reach END) AS least"), F.expr("max(CASE WHEN direct THEN reach END) AS most"), F.expr("count_if(NOT direct) AS others"))
        asked = asked.where("others > 0").withColumnRenamed("signature", "of")
        may_link = F.expr("CASE WHEN direct THEN reach >= least ELSE reach <= most OR others > 1 END")
        kept = near.join(asked, (F.col("signature") == F.col("of")) & may_link).select("signature", "key", "place", "component")
        kept = staged(light(kept, members_of_runs), "kept")
        # runs of the same sets are one
        same = [F.min("component").alias("x"), F.max("component").alias("y"), F.max("place").alias("last"), F.expr("bit_xor(xxhash64(key))").alias("who")]
        open_runs = kept.groupBy("signature").agg(*same).where("x <> y").groupBy("who", "last").agg(F.min("signature").alias("signature"))
        open_runs = open_runs.select("signature", F.floor(F.col("last") / BLOCK).cast("long").alias("blocks"))
        open_runs = staged(light(open_runs, members_of_runs), "open")
        denied = answers.where("NOT linked").groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("denied"))
        members = kept.join(open_runs, "signature").select("signature", "key", F.floor(F.col("place") / BLOCK).cast("long").alias("block"), "blocks")
        members = members.join(at, "key").join(known.select("key", "sketch"), "key").join(denied, "id", "left").select("signature", "block", "blocks", "id", "component", "n_shingles", "sketch", "denied")
        members = members.withColumn("other", F.explode(F.expr("sequence(0L, blocks)")))
        members = members.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
        fresh = members.groupBy("signature", "one", "two").applyInArrow(_across, "signature long, x long, y long, a long, b long, more boolean")
        fresh = staged(fresh, "pairs")
        n, more = fresh.agg(F.count("*"), F.max("more")).first()
        if not n:
            break
        answers = staged(answers.unionByName(_verified(fresh.select("a", "b").distinct(), docs, id_column, text)), "answers")
        if more:
            # links only merge components: another round is for runs with two that gave out some of their pairs, none linked
            unsettled = fresh.where("more").join(answers, ["a", "b"]).groupBy("signature", "x", "y").agg(F.max("linked").alias("linked"))
            again = staged(light(unsettled.where("NOT linked").select("signature").distinct(), n), "again")
            more = bool(again.take(1))
            runs = runs.join(few(again), "signature", "left_semi")
    of_set = distinct.join(at.select("key", "id", "component"), ["key", "id"]).groupBy("key", "also").agg(F.min("component").alias("component"))
    out = sets.select("id", "n_shingles", "key", "also").join(of_set, ["key", "also"], "left")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id, with all its columns.

    Documents without id or without words are kept.
    """
    judged = staged(jaccard_components(docs), "groups")
    dropped = staged(light(judged.where("doc_id <> component_id").select("doc_id").distinct(), judged.count()), "dropped")
    return docs.join(few(dropped), "doc_id", "left_anti").select(docs.columns)
