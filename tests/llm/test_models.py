"""Quality, language, page extraction and mixing: held-out accuracy, exact sums and odd rows."""

from __future__ import annotations

import random
import re
import time

import pytest

from holdfast.llm import language, mixing, pages, quality

DOCS = "doc_id long, text string, lang string, source string, score double"


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()):
    return ". ".join(" ".join(rng.choice(words) for _ in range(8)).capitalize() for _ in range(n)) + "."


def junk(rng, n):
    return " ".join(rng.choice(["###", "$$$", "AB!!", "x%%%", "|"]) for _ in range(8 * n))


def test_quality(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.7
        rows.append((i, prose(rng, rng.randint(2, 20)) if good else junk(rng, rng.randint(2, 20)), "en", "s", 0.1))
        labels.append((i, int(good) if i % 50 else None, 0))
    rows += [(600, None, "en", "s", 0.1), (601, "", "en", "s", 0.1), (None, prose(rng, 4), "en", "s", 0.1), (602, prose(rng, 6000), "en", "s", 0.1), (5, rows[5][1], "en", "s", 0.1)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([*labels, (5, 1, 0), (9999, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    described = quality.with_statistics(docs)
    model = quality.fit(described, known)
    out = quality.scored(described, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.7) for r in out)
    truth = dict((i, y) for i, y, _ in labels if y is not None)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.predicted}
    nothing = quality.fit(described, known.where("false"))
    assert {r.score for r in quality.scored(described, nothing).collect()} == {1.0}
    assert quality.scored(quality.with_statistics(docs.where("false")), model).count() == 0


def test_isotonic_rises():
    knots, steps = quality.isotonic([0.0, 1.0, 2.0, 3.0], [1, 1, 2, 1], [0, 1, 0, 1])
    assert list(knots) == sorted(knots) and list(steps) == sorted(steps) and abs(steps[-1] - 1) < 1e-9


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(2)
    words = {"aa": "ka ko ki kun kas".split(), "bb": "the that this then than".split()}
    rows = [(i, prose(rng, 5, words[lang]), lang, f"host{i % 3}.example.org", 0.0) for i, lang in enumerate(rng.choice(["aa", "bb"]) for _ in range(300))]
    return spark.createDataFrame(rows, DOCS)


def test_language(spark, spoken):
    model = language.learned(spoken.where("doc_id < 150"))
    rows = language.document_rows(spoken)
    got = {r.doc_id: r.lang for r in language.identified(rows, ["doc_id"], model).collect()}
    assert all(got[r.doc_id] == r.lang for r in spoken.collect())
    odd = [(1, None, "aa", "h.aa"), (2, "", "bb", "h.aa"), (3, "12 34", None, None), (4, "the that this", "", ""), (5, "ka ko ki " * 20_000, "bb", "h.bb"), (6, "ka ko ki", "aa", "192.168.0.1")]
    frame = spark.createDataFrame(odd, "doc_id long, text string, declared string, host string")
    out = {r.doc_id: r for r in language.identified(frame, ["doc_id"], model).collect()}
    assert len(out) == 6 and out[4].lang == "bb" and out[5].lang == "aa" and all(0 < r.probability <= 1 for r in out.values())
    assert language.identified(frame, ["doc_id"], {}).where("lang IS NOT NULL").count() == 0
    assert language.identified(frame.where("false"), ["doc_id"], model).count() == 0


def test_language_other_evidence_decides(spark):
    import numpy as np

    flat = {n: np.log(np.full(language.BUCKETS, 1 / language.BUCKETS)) for n in ("aa", "bb")}
    flat["aa"] = flat["aa"].copy()
    flat["aa"][:4000] += 0.5
    flat["bb"] = flat["bb"].copy()
    flat["bb"][4000:] += 0.5
    rows = [(i, f"text {chr(97 + i % 26) * 3} {i}", "xx" if i % 2 else "yy", "a.one.org" if i % 2 else "b.two.net") for i in range(100)] + [(100, "", "xx", "a.one.org")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string")
    out = {r.doc_id: r for r in language.identified(frame, ["doc_id"], flat).collect()}
    assert out[100].text_lang is None and out[100].lang in ("aa", "bb")


def test_mixing_exact(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["a", "b", "c", "B", None]), 0.0) for i in range(3000)]
    rows += [(3000, None, "en", "a", 0.0), (3001, "", "en", None, 0.0), (None, "x y z", "en", "c", 0.0), (7, rows[7][1], "en", rows[7][3], 0.0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mixed(docs).collect()
    again = mixing.mixed(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["size"], r.taken)
    assert sorted(out, key=key) == sorted(again, key=key) and len(out) == len(rows)
    want: dict = {}
    for _, t, _, s, _ in rows:
        want[s] = want.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    goal = mixing.targets(list(want.items()), sum(want.values()))
    assert abs(sum(goal.values()) - sum(want.values())) < 1e-6
    for s in want:
        got = [r for r in out if r.source_size == want[s] and abs(r.target - goal[s]) < 1e-9]
        assert abs(sum(r.taken for r in got) - goal[s]) <= max(60, 0.01 * goal[s])
    assert all(0 <= r.taken <= 3 * r["size"] for r in out)
    assert mixing.mixed(docs.where("false")).count() == 0


def test_targets_are_capped():
    goal = mixing.targets([("a", 1000), ("b", 10), (None, 100)], 1110)
    assert goal["b"] == 30 and goal[None] == 300 and abs(sum(goal.values()) - 1110) < 1e-9


def test_flow_prefers_single_use():
    flow = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 5}, {"a": 10, "b": 15})
    assert sum(flow.values()) == 25 and sum(n for (p, _), n in flow.items() if p == ("a", "b")) == 10
    assert sum(mixing.min_cost_flow({("a",): 10}, {"a": 25}).values()) == 25
    assert sum(mixing.min_cost_flow({("a",): 10}, {"a": 45}).values()) == 30


def test_flows_of_parts_equal_the_whole():
    rng = random.Random(9)
    for _ in range(30):
        capacity = {tuple(sorted(rng.sample("abcdefgh", rng.choice([1, 1, 1, 2, 3])))): rng.randint(1, 40) for _ in range(5)}
        quota = {s: rng.randint(0, 90) for p in capacity for s in p}

        def cost(flow):
            taken = {p: sum(n for (q, _), n in flow.items() if q == p) for p in capacity}
            return sum(taken.values()), sum(max(0, taken[p] - level * capacity[p]) for p in capacity for level in (1, 2))

        parts, whole = mixing.flows(capacity, quota), mixing.min_cost_flow(capacity, quota)
        assert cost(parts) == cost(whole)
        assert all(sum(n for (_, t), n in parts.items() if t == s) <= quota[s] for s in quota)


def test_many_single_sources_take_seconds():
    begun = time.time()
    sizes = {(f"s{i}",): i % 50 + 1 for i in range(20_000)}
    goal = mixing.targets([(p[0], n) for p, n in sizes.items()], sum(sizes.values()))
    flow = mixing.flows(sizes, {s: round(t) for s, t in goal.items()})
    assert time.time() - begun < 20
    assert abs(sum(flow.values()) - sum(sizes.values())) <= 20_000
    assert all(n <= 3 * sizes[p] for (p, _), n in flow.items())


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, "w " * 10, [["a"], ["a", "b"], ["b", None], []][i % 4]) for i in range(400)], "doc_id long, text string, sources array<string>")
    picked, goals = mixing.mix(docs, mixing.F.col("sources"))
    taken = picked.agg({"taken": "sum"}).first()[0]
    assert abs(taken - sum(r.target for r in goals.collect())) <= 40 and picked.count() == 400


@pytest.fixture(scope="module")
def model():
    rng = random.Random(8)
    made = [
        "<html><body><nav><a href='/'>Home</a></nav><article><h1>" + prose(rng, 1) + "</h1>" + "".join(f"<p>{prose(rng, rng.randint(1, 5))}</p>" for _ in range(4)) + "</article><footer>&copy; x</footer></body></html>"
        for _ in range(30)
    ]
    return pages.train(made)


def test_pages_extract_article_only(model):
    rng = random.Random(11)
    content, other = [prose(rng, n) for n in (1, 2, 3, 4)], ["Home", "Sign up now", prose(rng, 2), "Terms and privacy"]
    right = total = 0
    for _ in range(60):
        nodes = pages.parse(pages.labelled_page(rng, content, other)).nodes
        p = pages.marginals([n.parent for n in nodes], [model.unary(n) for n in nodes], model.together)
        for n, q in zip(nodes, p):
            if n.text is not None:
                total += 1
                right += (q > 0.5) == (nodes[n.parent].label == "1")
    assert right / total > 0.93


def test_pages_text(model):
    page = "<body><nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>One two\n  three,&nbsp;four &#233;.<br>Five six seven.<p>Unclosed <b>bold</b> text here.<script>if (a<b) {}</script><!-- no --></article></body>"
    assert pages.main_text(page, model) == "A & B\nOne two three, four é. Five six seven.\nUnclosed bold text here."


def test_pages_marginals_match_enumeration():
    from itertools import product
    from math import exp

    parents, unary, together = [-1, 0, 0, 1, 1], [0.2, -0.5, 1.0, 0.7, -1.2], [[-0.1, -2.0], [-1.0, -0.4]]
    total, on = 0.0, [0.0] * 5
    for x in product((0, 1), repeat=5):
        w = exp(sum(u for u, v in zip(unary, x) if v) + sum(together[x[parents[i]]][x[i]] for i in range(1, 5)))
        total += w
        on = [a + w * v for a, v in zip(on, x)]
    assert all(abs(a / total - b) < 1e-9 for a, b in zip(on, pages.marginals(parents, unary, together)))


def test_pages_frame(spark, model):
    long_page = "<article>" + "<p>Words that go on and on, as they do.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "u", long_page, 3), (3, "u", "<article><p>A text of some words, here.</p></article>", 4), (None, "u", "<<>><p", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    out = pages.extracted(frame, model).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id in (1, 2)} == {""} and max(r.text.count("\n") for r in out) == 19_999
    assert pages.extracted(frame.where("false")).count() == 0
