"""License scan, secret scan, decontamination and repeat removal against plain loops, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import contamination, licenses, secret_scan, suffixes

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"


def words(text):
    return ALNUM.findall((text or "").translate(FOLD))


def frame(spark, texts, ids=None):
    """Documents with an extra column whose name clashes with outputs."""
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t), 0.5) for i, t in zip(ids, texts)], SCHEMA)


def odd_texts():
    rng = random.Random(3)
    prose = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(40_000))
    return [None, "", " ", "é", prose, prose, "x\n\n\ny", "Ünïcode wörds ÀÉ"]


def test_license_scan(spark):
    texts = [
        *odd_texts(), "Released under the MIT License.", "the mit license the mit license", "THE MIT; license", "apache license, version 2", "cc by nc", "ccby nc",
        "Licensed under the Apache License, Version 2.0 (the License); you may NOT ever use this file except in compliance with the License. You may obtain a copy of the License at x",
        "This work is licensed under the GNU General Public License, version 3.",
    ]
    got = {r.doc_id: r for r in licenses.licenses(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        w = words(text)
        places = [(j, label) for phrase, label in licenses.PHRASES for j in range(len(w)) if w[j : j + len(phrase.split())] == phrase.split()]
        starts = [j for j, _ in places]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert got[i].base_labels == ",".join(sorted({label for _, label in places}))
        assert set(got[i].base_labels.split(",")) <= set(got[i].labels.split(",")) | {""}
        assert 0 <= got[i].score <= 1
    assert "apache-2" in got[14].labels and got[14].base_labels == "apache-2"
    assert got[15].labels == "gpl-3"
    assert licenses.licenses(frame(spark, []).where("false")).count() == 0


def test_license_scan_counts_the_phrases_of_its_contract(spark):
    """The first base phrase begins with "under"; without it the method's label stays."""
    texts = ["Released UNDER the MIT-license, under the mit license", "the mit license the mit license", "apache license version 2", "under cc by nc"]
    rows = sorted(licenses.licenses(frame(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == [
        (9, 2, 1, 5, "mit"), (6, 0, None, None, ""), (4, 1, 0, 0, "apache-2"), (4, 1, 1, 1, "cc-by-nc"),
    ]
    assert [r.labels for r in rows] == ["mit", "mit", "apache-2", "cc-by-nc"]


def test_license_scan_repeated_rows(spark):
    rows = licenses.licenses(frame(spark, ["under the mit license"] * 3, [1, 1, None])).collect()
    assert [r.n_base for r in rows] == [1, 1, 1]


@pytest.mark.parametrize("block", [1, 1_000_000])
def test_decontamination(spark, block):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(0, some(15)), (1, some(40)), (2, "short item"), (3, None), (4, ""), (5, some(12)), (None, some(11)), (5, "w1 w2 w3"), (-1, some(10)), (-7, "w4 w5 w6")]
    texts = [*odd_texts(), *(some(200) for _ in range(40))]
    texts += [some(20) + " " + items[1][1].upper() + ". " + some(5), "a Short, ITEM b", " ".join(words(items[0][1])[:9]), items[0][1] + " " + items[0][1], "short"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[j : j + n]), set()).add(i)
    docs = frame(spark, texts)
    searched = contamination.with_matches(docs.select("doc_id", "text"), bench, block_words=block)
    assert searched.count() == len(texts)
    got = {r.doc_id: r for r in contamination.contamination(docs, bench).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= ids
        names = sorted(str(x) for x in found if x is not None)
        want = (len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == want
    kept = contamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.contaminated}
    assert contamination.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert contamination.contamination(docs.where("false"), bench).count() == 0


def repeats(docs):
    out = {}
    for i, text in docs:
        b = (text or "").encode()
        gone = [False] * (len(b) + 1)
        for j in range(len(b) - 49):
            if any(k < i and b[j : j + 50] in o for k, o in ((k, (t or "").encode()) for k, t in docs)):
                gone[j : j + 50] = [True] * 50
        runs = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(gone)))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def _batch(rows):
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.binary())], names=["bucket", "doc", "start", "body"])


@pytest.mark.parametrize("sizes", [[9], [1, 1, 1, 2, 4]])
@pytest.mark.parametrize("colliding", [False, True])
def test_crowded_strings_are_told_apart(monkeypatch, sizes, colliding):
    a, b, c, d, e = b"a" * 50, b"b" * 49 + b"\0", b"c" * 50, b"d" * 50, b"e" * 50
    rows = [(5, 1, 0, a), (5, 3, 7, a), (5, 4, 0, b), (7, 1, 3, c), (7, 2, 0, d + c[:1]), (7, 2, 1, d), (7, 8, 0, c), (9, 1, 0, e), (9, 2, 0, e[1:] + b"f")]
    if colliding:  # every string has the same name
        monkeypatch.setattr(suffixes, "span_hashes", lambda sums, starts, ends: np.zeros(len(starts), np.uint64))
    batches, at = [], 0
    for n in sizes:
        batches.append(_batch(rows[at : at + n]))
        at += n
    got = sorted(r for out in suffixes._sorted_buckets(iter(batches)) for r in zip(*(c.to_pylist() for c in out.columns)))
    assert got == [(3, 7, 7), (8, 0, 0)]


@pytest.mark.parametrize("crowd", [2, 20_000])
def test_repeat_removal(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    line = some(60)
    texts = [None, "", "a" * 49, "a" * 50, "a" * 51, "a" * 300, line, line, some(400) + line + some(100), line[:50], line[:49], line[5:56] + some(60) + line]
    texts += [some(200) + line + some(20) + line for _ in range(6)] + ["ab" * 100, "ba" * 90, some(500)]
    texts += [texts[-1][:250] + "X" + texts[-1][250:]]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.without_repeats(frame(spark, texts)).collect()}
    assert got == repeats(docs)
    assert suffixes.without_repeats(frame(spark, []).where("false")).count() == 0


def test_repeat_removal_without_ids(spark):
    rows = suffixes.without_repeats(frame(spark, ["b" * 80, "b" * 80, "b" * 80], [None, 2, 2])).collect()
    assert [r.n_removed for r in rows] == [0, 0, 0]


def test_secret_scan(spark):
    hexa = hashlib.sha1(b"1").hexdigest()
    texts = [None, "", "plain words only", f'here token = "{hexa}" and more', f"api_key={hexa.upper()} x", f"fixed in commit {hexa} today", "mail to 3@mail7.example.com now", f'token = "{hexa}" token = "{hexa}"']
    docs = frame(spark, texts)
    found = secret_scan.findings(docs).collect()
    hit = {(r.doc_id, r.place, r.value) for r in found if r.is_secret}
    assert hit == {(3, 3, hexa), (4, 0, hexa.upper()), (7, 2, hexa), (7, 5, hexa)}
    masked = secret_scan.masked(docs)
    assert masked.columns == docs.columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert len(rows) == len(texts) and rows[3].text == 'here token = "[SECRET]" and more' and rows[3].n_chars == len(rows[3].text)
    assert rows[0].text is None and rows[5].text == texts[5] and rows[6].n_chars == len(texts[6])
    assert secret_scan.findings(docs.where("false")).count() == 0


def test_secret_scan_of_assigned_values(spark):
    secrets = [
        ('set password = "hunter2024" now', 3, "hunter2024"), ("db postgres://admin:Passw0rd!@host/main is up", 1, "Passw0rd!"), ("pwd: Tr0ub4dor&3 was used", 1, "Tr0ub4dor&3"),
        ("run DB_PASSWORD=s3cr3t!9x&user=anna", 1, "s3cr3t!9x"), ('{"passwd": "Correct!Horse#Staple"}', 1, "Correct!Horse#Staple"),
    ]
    plain = ["password: required", "mailto:anna.smith@mail.org", "the secret: always be kind", "password = get_password()", "pwd = short", f"password: {secret_scan.MASK} x"]
    docs = frame(spark, [t for t, _, _ in secrets] + plain)
    seen = secret_scan.findings(docs).collect()
    found = {(r.doc_id, r.place, r.value) for r in seen}
    assert {(i, p, v) for i, (_, p, v) in enumerate(secrets)} <= found and len(found) == len(seen)
    assert not any(secret_scan.MASK in r.value for r in seen)
    assert {(r.doc_id, r.place, r.value) for r in seen if r.is_secret} == {(i, p, v) for i, (_, p, v) in enumerate(secrets)}
    texts = {r.doc_id: r.text for r in secret_scan.masked(docs).collect()}
    assert texts == {i: t.replace(v, secret_scan.MASK) for i, (t, _, v) in enumerate(secrets)} | {i: t for i, t in enumerate(plain, len(secrets))}


def test_secret_values_start_in_their_word(spark):
    texts = ['a token = "two words  here" and\nsecret=abc!def,pwd=ghi?jkl.', "x \x01 password: a1\x02b2c3d4 y", "token=" + "a,b;" * 5000]
    found = [(r.doc_id, r.place, r.value) for r in secret_scan.candidates(frame(spark, texts).selectExpr("doc_id", "text", "source AS path"), ["doc_id"]).collect()]
    assert sorted(f for f in found if f[0] == 0) == [(0, 3, "two words  here"), (0, 7, "abc!def"), (0, 7, "ghi?jkl")]
    assert [f[1] for f in found if f[0] == 2] == [0]


def test_secret_forest_held_out(spark):
    train, test = secret_scan.labelled(spark, 800, 1), secret_scan.labelled(spark, 300, 2)
    docs = test.selectExpr("monotonically_increasing_id() AS doc_id", "text", "path AS source", "label")
    judged = secret_scan.findings(docs, train).groupBy("doc_id").agg({"score": "max"}).withColumnRenamed("max(score)", "s")
    both = docs.join(judged, "doc_id").selectExpr("avg(CAST((s >= 0.5) = (label = 1) AS double)) AS right").first()
    assert both.right > 0.93
