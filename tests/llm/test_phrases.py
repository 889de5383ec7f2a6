"""Phrase collocations against plain counting, with odd rows and small tiles."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from holdfast.llm import phrases

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, rank int, word string, n string"


def plain(docs, top, least):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", (text or "").translate(FOLD)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for m in (1, 2, 3, 4):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i : i + m]] = max(longer[lang, w[i : i + m]], a)
    out = []
    for (lang, w), a in found.items():
        if 100 * longer[lang, w] >= 80 * a:
            continue
        score, k = min(((2000000 * a) // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def found(frame):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def odd_docs():
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "日本", "\x00", "a'b", "\x85", "x" * 5000]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    said = lambda n: "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]) for w in rng.choices(vocabulary, weights, k=n))
    docs = [(said(rng.randrange(1, 120)), rng.choice(["en", "de", None, "", "und"])) for _ in range(150)]
    docs += [(None, "en"), ("", "en"), (" \t. ,;", None), ("one", "fr"), ("New YORK city hall " * 40, "en"), ("a " * 500, "aa"), ("ab:ab:" * 200, "aa")]
    docs += [("Hot line of words. " * 3, "en")] * 60 + [(said(6000), "de")]
    return docs


@pytest.mark.parametrize(("ranked", "tile", "held", "chunk", "spread"), [(65_536, 256, 1_000_000, 1_000_000, 64), (7, 2, 10, 500, 3), (40, 4, 100, 20_000, 1)])
def test_equals_plain_counting(spark, ranked, tile, held, chunk, spread):
    settings = phrases.Settings(least=5, ranked=ranked, tile=tile, dense=2 * tile, held=held, bits=1 << 12, spread=spread, chunk=chunk)
    docs = odd_docs()
    table = spark.createDataFrame([(i, t, g, 1, "clash", "n") for i, (t, g) in enumerate(docs)], SCHEMA).repartition(5)
    for top in (2000, 3):
        assert found(phrases.collocations(table, top, settings)) == plain(docs, top, 5)


def test_no_phrases_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(empty).count() == 0
    few = spark.createDataFrame([(1, "just a few words", "en", 1, "w", "n"), (2, None, None, 1, "w", "n")], SCHEMA)
    assert phrases.collocations(few).count() == 0


@pytest.mark.parametrize("dense", [1, 50, 10**9])
def test_tiles_count_every_cell(dense):
    settings = phrases.Settings(dense=dense)
    rng = np.random.default_rng(5)
    a, b = (np.minimum(rng.zipf(1.3, 20_000), settings.ranked) - 1 for _ in range(2))
    i, j, n = phrases.tiled(a, b, settings)
    assert dict(zip(zip(i.tolist(), j.tolist()), n.tolist())) == Counter(zip(a.tolist(), b.tolist())) and len(set(zip(i.tolist(), j.tolist()))) == len(i)
