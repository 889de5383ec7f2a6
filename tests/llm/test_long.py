"""Long texts of one shape: a megabyte takes seconds, not hours."""

import time

import pytest

from holdfast.llm import pages, secret_scan

SIZE = 1 << 20
EVEN = pages.Model({}, [[0.0, 0.0], [0.0, 0.0]])


@pytest.mark.parametrize("shape", ["<b x ", "<b", "<li>", "<div><li>", "<ul><li>", "</x>", "<div></x>", "<b \"", "<b '\"", "<td>", "<!--", "<script>", "&#9999", "<a b=c", "<div id=\"x"])
def test_pages_of_one_shape(shape):
    begun = time.time()
    pages.main_text(shape * (SIZE // len(shape)), EVEN)
    assert time.time() - begun < 15


def test_pages_nested_lists_in_deep_trees():
    nodes = pages.parse("<div>" * 20_000 + "<li>x" * 20_000).nodes
    assert {n.parent for n in nodes if n.tag == "li"} == {20_000}


def test_pages_long_references_and_attributes():
    assert pages.main_text("<p>a&#" + "9" * 5000 + ";&#" + "0" * 5000 + "65;b</p>", pages.Model({"one=text": 50.0}, EVEN.together)) == "a\N{REPLACEMENT CHARACTER}Ab"
    assert len(pages.parse("<div " + "a" * SIZE + " class='nav'>x</div>").nodes) == 3


def test_pages_tags_with_quotes_and_raw_text():
    texts = [n.text for n in pages.parse("<div title='a > b'>one</div><script>if (a < b) '</p>'</script>two <b x three <p class=\"<q>\">four</p>").nodes if n.text]
    assert texts == ["one", "two four"]  # the open <b takes all up to its >


@pytest.mark.parametrize(
    "text, n",
    [
        ("-" * SIZE, 0), ("a" * SIZE, 0), ("1" * SIZE, 1), ("a:" * (SIZE // 2) + "@h", 1), ("@a" + "a:" * (SIZE // 2), 0), ("token=" * (SIZE // 6), 1), ("token" + '"' * SIZE, 0),
        ('{"id":"0123456789abcdef0123","v":1},' * 20_000, 20_000), ('"token":"abc12!x",' * 20_000, 20_000),
    ],
)
def test_secrets_of_one_shape(spark, text, n):
    rows = spark.createDataFrame([(1, text, "p")], "doc_id long, text string, path string")
    begun = time.time()
    found = secret_scan.candidates(rows, ["doc_id"]).selectExpr("count(*)", "coalesce(max(length(before)), 0)").first()
    assert time.time() - begun < 30
    assert found[0] == n and found[1] <= 1000


def test_secret_candidates_know_what_stands_before_them(spark):
    text = 'x {"token":"abc123def456ghi789jkl","id":"0123456789abcdef0123","password":"hunter2x!"} ftp://me:pa55wd!x@host token=abcdefgh12345678. //:s3cr3t!!@h u:[SECRET]@h n:abcdefg@h1@h2:zz u:pw:1@h'
    rows = spark.createDataFrame([(1, text, "p")], "doc_id long, text string, path string")
    found = {(r.value, r.place): r.before for r in secret_scan.candidates(rows, ["doc_id"]).collect()}
    assert sorted(found) == sorted([
        ("abc123def456ghi789jkl", 1), ("0123456789abcdef0123", 1), ("hunter2x!", 1), ("pa55wd!x", 2), ("abcdefgh12345678.", 3), ("abcdefgh12345678", 3), ("s3cr3t!!", 4), ("abcdefg@h1", 6),
    ])
    assert found["0123456789abcdef0123", 1] == 'x ","id":"'
    assert found["hunter2x!", 1].endswith('"password":"')
    assert found["pa55wd!x", 2].endswith("ftp://me:")
