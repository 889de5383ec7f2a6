"""Centroid clustering of integer vectors with an exact equal-average equal-variance search.

Centroids are sorted by the sum of their components. A vector starts at its own sum and scans outward; a side
is given up once the mean inequality (S - C)^2 / n > best rules it out, since centroids further out are further away
still, and a single centroid is skipped when the mean and deviation inequality (S - C)^2 / n + (V - W)^2 > best does,
with V and W the root of the squared deviations from the mean. Distances that are computed are sums of integers.
Rounds send the centroids (k of them) to the tasks and get one sum per centroid and component back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import staged

SCALE = 256
COMPONENTS = 64
CENTROIDS = 40
ROUNDS = 5
SEED = 2
# Scaled components are held to this, so that distances and sums stay whole in 64 bits.
MOST = 2**27
# Share by which a rounded lower bound must exceed the best distance to count (rounding errors are far smaller).
MARGIN = 1e-9
# Vectors searched at a time in a task.
BLOCK = 4096


def usable(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, embedding) of the vectors with exactly this many components, all finite."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('infinity'))"
    return vectors.select("vec_id", "embedding").where(f"embedding IS NOT NULL AND size(embedding) = {components} AND {finite}")


def scaled(column: pa.Array, components: int) -> np.ndarray:
    """The vectors as integers floor(SCALE * x), one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64).reshape(-1, components)


class Centroids:
    """Centroids in the order of their sums, as the search needs them."""

    def __init__(self, rows: np.ndarray) -> None:
        sums = rows.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.rows, self.sums = rows[self.number], sums[self.number]
        self.deviations = _deviations(self.rows)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid; of equally near ones the smallest number."""
        n, components = x.shape
        sums, deviations = x.sum(axis=1), _deviations(x)
        k = len(self.sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, dtype=np.int64)
        active = np.arange(n)
        far = np.iinfo(np.int64).max
        while len(active):
            lo, hi = left[active], right[active]
            down = np.where(lo >= 0, np.abs(sums[active] - self.sums[np.maximum(lo, 0)]), far)
            up = np.where(hi < k, np.abs(sums[active] - self.sums[np.minimum(hi, k - 1)]), far)
            lower = down <= up
            at, gap = np.where(lower, lo, hi), np.minimum(down, up)
            mean = gap.astype(np.float64) ** 2 / components
            limit = best[active].astype(np.float64) * (1 + MARGIN) + 1
            inside = (gap != far) & (mean <= limit)
            active, at, lower, mean, limit = active[inside], at[inside], lower[inside], mean[inside], limit[inside]
            left[active] -= lower
            right[active] += ~lower
            close = mean + (deviations[active] - self.deviations[at]) ** 2 <= limit
            rows, c = active[close], at[close]
            distance = ((x[rows] - self.rows[c]) ** 2).sum(axis=1)
            better = (distance < best[rows]) | ((distance == best[rows]) & (self.number[c] < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], self.number[c[better]]
        return number, best


def _deviations(rows: np.ndarray) -> np.ndarray:
    """Root of the summed squared deviations of each row from its mean."""
    centred = rows - rows.mean(axis=1, keepdims=True)
    return np.sqrt((centred**2).sum(axis=1))


def _assigned(batches: Iterator[pa.RecordBatch], rows: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    centroids = Centroids(rows)
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            x = scaled(part.column(1), rows.shape[1])
            yield part, x, *centroids.nearest(x)


def _sums(rows: np.ndarray):
    """Tasks that return (cluster, component, n, total): what their vectors add to each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(rows.shape, dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        for _, x, cluster, _ in _assigned(batches, rows):
            order = np.argsort(cluster, kind="stable")
            heads = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            totals[cluster[order[heads]]] += np.add.reduceat(x[order], heads, axis=0)
            counts += np.bincount(cluster, minlength=len(rows))
        cluster, component = (i.ravel() for i in np.indices(rows.shape))
        keep = counts[cluster] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster[keep], pa.int32()), pa.array(component[keep], pa.int32()), pa.array(counts[cluster[keep]]), pa.array(totals.ravel()[keep])],
            names=["cluster", "component", "n", "total"],
        )

    return run


def _final(rows: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance in _assigned(batches, rows):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of smallest sha256 of `seed:vec_id`; equal ids are told apart by their components, null ids come last."""
    named = vectors.select("embedding", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("name"))
    first = named.orderBy(F.col("name").asc_nulls_last(), "embedding").limit(k).toArrow()
    column = first.column("embedding").combine_chunks()
    return scaled(column, len(column[0]) if len(column) else 1)


def moved(vectors: DataFrame, rows: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floored mean of its vectors; a centroid without vectors stays."""
    parts = vectors.mapInArrow(_sums(rows), "cluster int, component int, n long, total long")
    totals = parts.groupBy("cluster", "component").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    after = rows.copy()
    for r in totals.toLocalIterator():
        after[r["cluster"], r["component"]] = int(r["total"]) // int(r["n"])
    return after


def clustered(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, have another number of components, or null or non-finite ones are left out. Fewer
    vectors than k make as many centroids; no vector, no rows. Repeated rows count each; a null vec_id is kept but
    chosen as a start only when there are no others. Of equally near centroids the smallest number wins. Scaled components beyond
    2^27 in size are held there, sums of distances beyond 64 bits at the largest long.
    """
    kept = usable(vectors, components)
    rows = starts(kept, k, seed)
    for _ in range(rounds if len(rows) else 0):
        rows = moved(kept, rows)
    assigned = staged(kept.mapInArrow(_final(rows), "vec_id long, cluster int, distance long"), "assigned")
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    total = lambda c: F.least(F.sum(F.col(c).cast("decimal(38,0)")), most).cast("long")
    digests = [(i, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for i, row in enumerate(rows.tolist())]
    names = vectors.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertia = assigned.groupBy("cluster").agg(total("distance").alias("cluster_inertia"))
    everything = assigned.agg(total("distance").alias("inertia"))
    # k rows of sums, and one
    told = inertia.join(F.broadcast(names), "cluster").crossJoin(F.broadcast(everything))
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle() -> str:
    """The registered query as DuckDB SQL: every round compares all vectors with all centroids."""
    parts = [
        f"""kept AS (
          SELECT row_number() OVER () AS row, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
          FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""c0 AS (
          SELECT row_number() OVER (ORDER BY name) - 1 AS cluster, v FROM (SELECT v, sha256('{SEED}:' || vec_id) AS name FROM kept ORDER BY name LIMIT {CENTROIDS}))""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS (
              SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS best
              FROM (SELECT k.row, k.vec_id, k.v, c.cluster, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(k.v, c.v)]) AS d FROM kept k, c{i} c)
              GROUP BY row)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""c{i + 1} AS (
                  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                    SELECT cluster, list(mean ORDER BY i) AS v FROM (
                      SELECT best.cluster AS cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
                      FROM a{i}, generate_series(1, {COMPONENTS}) g(i) GROUP BY best.cluster, i) GROUP BY cluster) m ON c.cluster = m.cluster)"""
            )
    return f"""
      WITH {', '.join(parts)}
      SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
        CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
      FROM a{ROUNDS} JOIN c{ROUNDS} ON best.cluster = c{ROUNDS}.cluster"""
