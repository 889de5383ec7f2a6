"""Centroid clustering against a plain loop over all centroids, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from holdfast.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def plain(rows, k, rounds, components):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(cs)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                cs[n] = [sum(col) // len(mine) for col in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    per = {n: sum(d for _, d, c in last if c == n) for n in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((repr(i), n, d, per[n], sum(per.values()), sha[n]) for i, d, n in last)


def rows_of(frame):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, "clash") for i, v in rows], SCHEMA)


def odd_rows(rng, components):
    point = lambda spread: [rng.gauss(0, spread) for _ in range(components)]
    rows = [(i, point(rng.choice([0.01, 0.3, 2]))) for i in range(120)]
    same = point(0.3)
    rows += [(200 + i, list(same)) for i in range(60)]  # a third of the rows is one vector
    rows += [(3, rows[3][1]), (3, rows[3][1]), (4, point(1))]  # repeated rows, one id with two vectors
    rows += [(None, point(0.3)), (300, [0.0] * components), (301, [-0.0] * components), (302, [1000.0] * components), (303, [-1000.0] * components)]
    rows += [(400, None), (401, []), (402, same[:-1]), (403, same + [0.0]), (404, [None] + same[1:]), (405, [math.nan] + same[1:]), (406, [math.inf] + same[1:])]
    return rows


@pytest.mark.parametrize(("components", "k", "rounds"), [(64, 40, 5), (3, 7, 3), (1, 12, 2), (4, 1, 2), (5, 500, 2)])
def test_equals_search_of_all_centroids(spark, components, k, rounds):
    rows = odd_rows(random.Random(components), components)
    got = rows_of(centroids.clustered(table(spark, rows).repartition(5), k=k, rounds=rounds, components=components))
    assert got == plain(rows, k, rounds, components)


def test_search_keeps_ties_and_the_smallest_number():
    rng = np.random.default_rng(3)
    rows = rng.integers(-3, 4, size=(50, 4))
    rows[20:30] = rows[0]
    x = rng.integers(-3, 4, size=(4000, 4))
    number, distance = centroids.Centroids(rows).nearest(x)
    every = ((x[:, None, :] - rows[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_search_over_spread_centroids():
    rng = np.random.default_rng(4)
    rows = (rng.normal(0, 1, size=(400, 8)) * 50 + rng.normal(0, 400, size=(400, 1))).astype(np.int64)
    x = rows[rng.integers(0, 400, 500)] + rng.integers(-9, 10, size=(500, 8))
    number, distance = centroids.Centroids(rows).nearest(x)
    every = ((x[:, None, :] - rows[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


def test_huge_components_and_empty_tables(spark):
    rows = [(i, [3e38] * 64) for i in range(5)] + [(9, [-3e38] * 64), (10, [0.5] * 64)]
    got = centroids.clustered(table(spark, rows), k=2).collect()
    assert len(got) == 7 and all(r.distance >= 0 for r in got)
    assert centroids.clustered(table(spark, [])).count() == 0
    assert centroids.clustered(table(spark, [(1, None)])).count() == 0
