"""Similarity joins, embeddings and components against all pairs, with odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from holdfast.llm import jaccard, links, vectors

DOCS = "doc_id long, text string, n_shingles long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similar_groups(texts):
    sets = [shingle_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return groups(range(len(texts)), pairs), [len(s) for s in sets]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("per_pair", "block"), [(200, 1500), (1, 3)])
def test_jaccard_components(spark, monkeypatch, per_pair, block):
    monkeypatch.setattr(jaccard, "PER_PAIR", per_pair)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(1)
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f", "x " * 3000, "x " * 4000]
    passage = " ".join(f"p{i}" for i in range(30))
    for size in (8, 10, 13, 17, 25, 29, 34, 60, 66, 75, 90, 130, 300, 700, 2500):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts.append(" ".join(base))
        texts += [edited(rng, base, max(1, k * size // 120)) for k in (1, 2, 3, 4, 5)]
        texts.append(" ".join(base[: size * 5 // 6]) + " " + passage)
        texts.append(" ".join(base).upper())
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) for _ in range(8)]
    want, sizes = similar_groups(texts)
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], DOCS).repartition(4)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: (want[i], sizes[i]) for i in want}
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_jaccard_threshold_pairs_share_a_signature():
    rng = np.random.default_rng(5)
    for low in (4, 7, 12, 24, 33, 63, 64, 85, 128, 400):
        for _ in range(40):
            shared = rng.integers(0, 2**63, size=low * 6 // 7 + 1, dtype=np.uint64)
            each = len(shared) // 6
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, size=each, dtype=np.uint64)])) for _ in range(2))
            both = len(np.intersect1d(a, b))
            if each and 100 * both >= 75 * (len(a) + len(b) - both):
                assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)))


def test_jaccard_small_sets_at_the_threshold_share_a_signature():
    rng = np.random.default_rng(7)
    for n in range(1, 41):
        for m in range(n, 41):
            both = -(-3 * (n + m) // 7)  # the fewest shared shingles of a similar pair
            if both > n:
                continue
            for _ in range(5):
                shared, a, b = (rng.integers(0, 2**63, size=k, dtype=np.uint64) for k in (both, n - both, m - both))
                a, b = np.sort(np.concatenate([shared, a])), np.sort(np.concatenate([shared, b]))
                assert n == m == both or len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b))), (n, m)


def test_jaccard_components_of_short_texts(spark):
    rng = random.Random(12)
    texts = []
    for size in (5, 6, 7, 8, 9, 10, 11):
        for _ in range(6):
            base = [f"s{rng.randrange(10**6)}" for _ in range(size)]
            texts += [" ".join(base), " ".join([*base, "end"]), " ".join(["start", *base]), " ".join([*base, "two", "more"]), edited(rng, base, 1)]
    want, sizes = similar_groups(texts)
    assert any(sizes[i] == 3 and want[i] != i or sizes[want[i]] == 3 and want[i] != i for i in want)
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], DOCS).repartition(4)
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.jaccard_components(docs).collect()} == {i: (want[i], sizes[i]) for i in want}
    assert sorted(r.doc_id for r in jaccard.representatives(docs).collect()) == sorted(i for i in want if want[i] == i)


def test_jaccard_odd_frames(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.representatives(empty).count() == 0
    rows = [(3, "a b c d e f g", 1), (3, "a b c d e f g", 1), (None, "a b c d e f g", 1), (None, "alone in the world of words", 1), (5, "a b c d e f g", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(3, 3), (3, 3), (None, 3), (None, None), (5, 3)], key=str)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(600, i) for i in range(601, 660)]
    nodes = {n for e in edges for n in e}
    want = groups(nodes, edges)
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: want[n] for n in {x for a, b in edges if a != b for x in (a, b)}}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("kind", "block"), [("float", 1000), ("double", 3)])
def test_vectors(spark, monkeypatch, kind, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(6):
        base = rng.standard_normal(16)
        for k in range(12):
            rows.append((base + rng.standard_normal(16) * 0.15 * (k % 4) * np.linalg.norm(base) / 16, int(k % 2)))
    rows += [(rows[0][0], 0), (rows[0][0] * 2.0, 0), (rows[0][0], None), (np.zeros(16), 0), (np.full(16, np.nan), 0), (np.full(16, 1e-30), 0), (np.full(16, 1e30), 0), (rng.standard_normal(4), 0)]
    rows += [(rng.standard_normal(16), 1) for _ in range(60)]
    data = [(i, [float(np.float32(v)) for v in x], y, 1) for i, (x, y) in enumerate(rows)]
    data += [(900, None, 0, 1), (901, [], 0, 1), (902, [None] * 16, 0, 1), (903, [float("inf")] * 16, 0, 1)]
    frame = spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>, label int, n_links long")
    ok = [(i, np.array(v, float), y) for i, v, y, _ in data if v and y is not None and None not in v and np.isfinite(v).all() and any(v)]
    pairs = []
    for p, (i, a, x) in enumerate(ok):
        for j, b, y in ok[:p]:
            if x == y and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                pairs.append((i, j))
    want = groups([d[0] for d in data], pairs)
    got = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    assert len(got) == len(data) and pairs
    for i in want:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (sum(i in p for p in pairs), want[i], want[i] == i)
    assert vectors.near_duplicates(frame.where("false")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(4)
    x = rng.uniform(-2, 2, (200, 8))
    point = vectors.nearest_point(x)
    own = ((x - point) ** 2).sum(axis=1)
    others = ((x[:, None, :] - point[:, None, :] - vectors._shortest_vectors()[None, :, :]) ** 2).sum(axis=2)
    assert (own <= others.min(axis=1) + 1e-9).all() and len(vectors._shortest_vectors()) == 240


def test_vector_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    u = rng.standard_normal((3000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((3000, 64))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    a, b = vectors.cells(u), vectors.cells(0.98 * u + np.sqrt(1 - 0.98**2) * w)
    assert ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1).mean() > 0.999
