"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected to eight dimensions at random, once per table, and decoded to the nearest point
of the E8 lattice. A vector stands in the cell of its own lattice point and asks in the cells of the
points that come next to being nearest; who meets in a cell is compared by cosine in double precision.
Equal vectors are one representative with a weight. Cells with many members are cut into blocks, and blocks
of one cell are compared two at a time, so no task holds a whole cell and no pair is ever a row: blocks
give link counts per vector, and edges that span their local groups. A pair that meets several times counts
where it meets first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import lists, mix
from holdfast.llm.links import components
from holdfast.session import staged

COSINE = 0.98
# A pair at the threshold meets in a table with probability 0.984, so all four miss it once in 10^7;
# two unrelated directions meet in one with probability 0.003. Larger scales part more and need more tables.
TABLES = 4
PROBES = 5  # neighbouring lattice points asked besides the own one
SCALE = 0.65  # lattice units per unit of a standard normal projection
SEED = 7
BLOCK = 1000  # vectors of a cell compared with as many others in one task
STEP = 256  # of them at a time
DIMENSIONS = 8  # of the E8 lattice

_U = np.uint64


def _half_integers(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (whole numbers with an even sum)."""
    whole = np.rint(x)
    rest = x - whole
    odd = np.flatnonzero(np.mod(whole.sum(axis=1), 2))
    worst = np.abs(rest[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return whole


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better one of D8 and D8 moved by one half in every direction."""
    plain, moved = _half_integers(x), _half_integers(x - 0.5) + 0.5
    closer = ((x - plain) ** 2).sum(axis=1) <= ((x - moved) ** 2).sum(axis=1)
    return np.where(closer[:, None], plain, moved)


def _shortest_vectors() -> np.ndarray:
    """The 240 neighbours of the origin in E8."""
    pairs = [(i, j) for i in range(DIMENSIONS) for j in range(i)]
    signs = [(a, b) for a in (1, -1) for b in (1, -1)]
    out = []
    for i, j in pairs:
        for a, b in signs:
            v = np.zeros(DIMENSIONS)
            v[i], v[j] = a, b
            out.append(v)
    for bits in range(1 << DIMENSIONS):
        v = np.array([0.5 if bits >> i & 1 else -0.5 for i in range(DIMENSIONS)])
        if v.sum() % 2 == 0:
            out.append(v)
    return np.array(out)


def cells(unit: np.ndarray) -> np.ndarray:
    """Cell numbers [vector, table, 1 + PROBES] of unit vectors: the own cell, then the next nearest."""
    rng = np.random.default_rng([SEED, unit.shape[1]])
    around = _shortest_vectors()
    out = np.zeros((len(unit), TABLES, 1 + PROBES), dtype=np.uint64)
    weights = mix(np.arange(1, DIMENSIONS + 1, dtype=np.uint64)) | _U(1)
    for t in range(TABLES):
        turn = rng.standard_normal((unit.shape[1], DIMENSIONS)) * SCALE
        x = unit @ turn + rng.uniform(-1, 1, DIMENSIONS)
        own = nearest_point(x)
        # |x - own - v|^2 = |x - own|^2 - 2 (x - own) v + 2 for every shortest v
        next_ones = np.argsort(-((x - own) @ around.T), axis=1, kind="stable")[:, :PROBES]
        points = np.concatenate([own[:, None, :], own[:, None, :] + around[next_ones]], axis=1)
        whole = np.rint(points * 2).astype(np.int64).astype(np.uint64)
        out[:, t] = mix((whole * weights).sum(axis=2, dtype=np.uint64) + mix(np.array([t + 1], dtype=np.uint64)))
    return out


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors at length one, in double precision; scaled first, so that squares stay in range."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, weight, vector) to (id, weight, packed vector, cells)."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            x = part.column(3).flatten().to_numpy().reshape(len(part), -1)
            label = part.column(1).to_numpy().astype(np.uint64)
            codes = mix(cells(_units(x)) + mix(label + _U(size) * _U(1_000_003))[:, None, None]).view(np.int64)
            arrays = [part.column(0), part.column(2), pa.array([v.tobytes() for v in x], pa.binary()), lists(codes.ravel(), np.full(len(part), TABLES * (1 + PROBES)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "weight", "vector", "cells"])


def _met_before(codes: np.ndarray, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """Whether pairs meet in a table before t; `codes` is [vector, table, own cell and cells asked]."""
    seen = np.zeros(len(i), dtype=bool)
    for s in range(t):
        seen |= (codes[i, s] == codes[j, s, :1]).any(axis=1) | (codes[j, s] == codes[i, s, :1]).any(axis=1)
    return seen


def _compare(kind: type):
    """Link counts and spanning edges of two blocks (or one) of a cell, for packed vectors of one kind."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id").combine_chunks()
        ids, weight, block = (table.column(c).to_numpy() for c in ("id", "weight", "block"))
        own = table.column("own").to_numpy()
        one, two, t = (table.column(c)[0].as_py() for c in ("one", "two", "number"))
        unit = _units(np.frombuffer(b"".join(table.column("vector").to_pylist()), dtype=kind).reshape(len(ids), -1))
        codes = np.stack(table.column("cells").to_numpy()).reshape(len(ids), TABLES, 1 + PROBES)
        links, edges = np.zeros(len(ids), dtype=np.int64), []
        for start in range(0, len(ids), STEP):
            near = unit[start : start + STEP] @ unit[start:].T >= COSINE
            i, j = np.nonzero(np.triu(near, 1))
            i, j = i + start, j + start
            # members of the cell meet each other and those who ask here; across blocks if these are two
            keep = own[i] | own[j]
            if one != two:
                keep &= block[i] != block[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            counted = ~_met_before(codes, i, j, t)
            back = own[j] & ~own[i]  # i asks j here; if j asks i's cell too, the pair counts there
            counted[back] &= ~(codes[j[back], t, 1:] == codes[i[back], t, :1]).any(axis=1)
            np.add.at(links, i[counted], weight[j[counted]])
            np.add.at(links, j[counted], weight[i[counted]])
            firsts = np.flatnonzero(np.concatenate([[True], np.diff(i) != 0]))
            edges += [(a, others) for a, others in zip(i[firsts].tolist(), np.split(j, firsts[1:]))]
        parent = np.arange(len(ids))
        # every vector to the smallest of its local group
        changed = True
        while changed:
            changed = False
            for a, others in edges:
                m = min(parent[a], parent[others].min())
                if parent[a] != m or (parent[others] != m).any():
                    parent[a], parent[others], changed = m, m, True
        moved, counted = np.flatnonzero(parent != np.arange(len(ids))), np.flatnonzero(links)
        return pa.table({
            "a": pa.array(np.concatenate([ids[counted], ids[moved]])),
            "b": pa.array(np.concatenate([ids[counted], ids[parent[moved]]])),
            "links": pa.array(np.concatenate([links[counted], np.zeros(len(moved), np.int64)])),
        })

    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: key, n_links, component_id and kept.

    Vectors link when their labels are equal and not null and their cosine is COSINE or more. Null, empty
    and zero vectors, and those with null or non-finite components, have no links. Rows that repeat a
    vector link with each other; a row repeated whole counts as another vector. Keys are integers; rows
    without key have no links and no component.
    """
    single = vectors.schema[vector].dataType == T.ArrayType(T.FloatType())
    double = vectors.schema[vector].dataType if single else T.ArrayType(T.DoubleType())
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast(double).alias("vector"))
    rows = staged(rows.withColumn("hash", F.xxhash64("label", "vector")), "vectors")
    usable = "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
    usable += " AND forall(vector, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')) AND exists(vector, v -> v <> 0)"
    distinct = rows.where(usable).groupBy("hash", "label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    distinct = staged(distinct, "distinct")
    coded = distinct.select("id", "label", "weight", "vector").mapInArrow(_coded, "id long, weight long, vector binary, cells array<long>")
    coded = staged(coded, "coded")
    placed = coded.select("id", F.posexplode("cells").alias("at", "cell"))
    placed = placed.selectExpr("id", "cell", f"at DIV {1 + PROBES} AS number", f"at % {1 + PROBES} = 0 AS own")
    crowds = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("own").alias("any")).where("n > 1 AND any")
    crowds = crowds.select("cell", F.floor((F.col("n") - 1) / BLOCK).cast("long").alias("blocks"))
    met = placed.join(crowds, "cell").withColumn("block", F.expr("pmod(xxhash64(id), blocks + 1)")).join(coded, "id")
    met = met.withColumn("other", F.explode(F.expr("sequence(0L, blocks)"))).withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    met = met.drop("blocks", "other")
    compare = _compare(np.float32 if single else np.float64)
    found = staged(met.groupBy("cell", "one", "two").applyInArrow(compare, "a long, b long, links long"), "found")
    counts = found.where("a = b").groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(found.where("a <> b").select("a", "b"))
    of_set = distinct.join(counts, distinct.id == counts.a, "left").join(groups, distinct.id == groups.node, "left")
    of_set = of_set.select("hash", "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    of_set = of_set.withColumn("label_", F.col("label")).withColumn("vector_", F.col("vector")).drop("label", "vector")
    joined = rows.join(of_set, (rows.hash == of_set.hash) & (rows.label == of_set.label_) & (rows.vector == of_set.vector_), "left")
    out = joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.expr(f"{key} = component_id"))
