"""WARC archives: round trips of hostile payloads and revisit resolution against a plain loop."""

from __future__ import annotations

import gzip
import glob
import hashlib
import random

import pytest

from holdfast.llm import warc
from holdfast.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload_bytes string, digest string, holder long, members int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "d", 5, 1) for i, u, h in rows], SCHEMA)


def plain(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    least = {}
    for i, p in data:
        if i is not None and len(p) >= 100:
            least[p] = min(i, least.get(p, i))
    out = []
    for i, p in data:
        holder = least.get(p)
        again = holder is not None and i != holder
        out.append((repr(i), len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", holder if again else None))
    return sorted(out)


def found(frame):
    return sorted((repr(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect())


def odd_rows():
    rng = random.Random(12)
    end = "\r\n\r\n"
    shapes = ["", "x" * 99, "x" * 100, "é" * 50, "é" * 49, end, end * 40, "\r\n" * 77, "\r" * 101, "\n" * 101, "a" * 100 + "\r\n", "a" * 100 + end, "a" * 100 + "\r\n\r"]
    shapes += [f"{end}WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 7{end}", "\r\n\r\r\n\r\n\n" * 30, "\0" * 120, "日本" * 60, " \x85\x0b" * 50]
    shapes += ["".join(rng.choice("\r\nab") for _ in range(rng.randrange(90, 400))) for _ in range(60)]
    shapes += ["long " + "word \r\n\r\n" * 200_000]
    rows = [(i, f"http://h/{i}", s) for i, s in enumerate(shapes)]
    rows += [(1000 + i, f"http://h/{i}", s) for i, s in enumerate(shapes)]
    rows += [(-5, "http://h/neg", "x" * 100), (2000, None, None), (2001, "http://h/a b\r\nX-Page-Id: 7\r\n\r\n\x7f", "y" * 200), (2002, "", "y" * 200)]
    rows += [(3000 + i, "http://hot", "hot page " * 20) for i in range(150)]  # one payload of many pages
    rows += [(1, "http://h/1", shapes[1]), (2, "http://h/2", shapes[2]), (-5, "http://h/neg", "x" * 100)]  # repeated rows
    rows += [(None, "u", "x" * 100), (None, "u", "none has an id " * 10), (None, "u", "none has an id " * 10), (2001, "u", "x" * 100)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("heavy", "parts"), [(10_000, 4), (1, 9), (10, 1)])
def test_archives_equal_a_plain_loop(spark, monkeypatch, heavy, parts):
    monkeypatch.setattr(warc, "HEAVY", heavy)
    rows = odd_rows()
    assert found(warc.archived(table(spark, rows).repartition(parts))) == plain(rows)


def test_round_trip_of_payloads_and_headers(spark):
    rows = odd_rows()
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, rows).repartition(6), path, date="2024-02-03T04:05:06Z")
    got = warc.read_archives(spark, path, most_bytes=1000).collect()
    assert len(got) == len(rows)
    kept = {(r.page_id, bytes(r.payload)) for r in got if r.record_type == "response"}
    payloads = {(h or "").encode() for _, _, h in rows}
    assert {p for _, p in kept} == payloads and kept <= {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.refers_to, next(p for p in payloads if hashlib.sha256(p).hexdigest() == r.payload_digest)) in kept for r in got if r.record_type == "revisit")
    assert all(r.payload is None and r.content_digest is None for r in got if r.record_type == "revisit")
    assert {r.date for r in got} == {"2024-02-03T04:05:06Z"}
    urls = {r.page_id: r.url for r in got}
    assert urls[2000] is None and urls[5] == "http://h/5" and urls[2001] in ("http://h/a%20b%0D%0AX-Page-Id:%207%0D%0A%0D%0A%7F", "u")


def test_files_are_framed_records(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, [(1, "http://a", "p" * 150), (2, "http://b", "p" * 150), (3, "http://c", "short")]).coalesce(1), path)
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{path}/*.gz")))
    seen = []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        n = int(fields["Content-Length"])
        block, data = rest[:n], rest[n:]
        assert data.startswith(b"\r\n\r\n") and block.startswith(b"HTTP/1.1 200 OK\r\n")
        data = data[4:]
        seen.append((fields["WARC-Type"], fields["X-Page-Id"], "WARC-Refers-To" in fields, len(block.split(b"\r\n\r\n", 1)[1]), fields["WARC-Record-ID"]))
    assert sorted(s[:4] for s in seen) == [("response", "1", False, 150), ("response", "3", False, 5), ("revisit", "2", True, 0)]
    assert len({s[4] for s in seen}) == 3


def test_damaged_archive_and_empty_table(spark):
    with pytest.raises(ValueError, match="inside a record"):
        import pyarrow as pa

        piece = pa.RecordBatch.from_arrays([pa.array(["WARC/1.1\r\nContent-Length: 99", "cut"])], names=["value"])
        list(warc._parsed(["page_id"], 10)(iter([piece])))
    assert warc.archived(table(spark, [])).count() == 0
