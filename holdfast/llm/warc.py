"""WARC archives whose repeated payloads are revisit records, written and read by Spark.

Records are rows of text: headers, an empty line, the block. Spark's text writer ends each row with the two line ends
that end a WARC record, so tasks write archives with its commit protocol, to any file system it knows. Headers are
shuffled by digest, whose smallest page is a grouped minimum; payloads stay where they are read, unless there are more revisits
than `links.few` broadcasts (three numbers each). Archives are gzip files, each read as one stream whose pieces are put together by Content-Length, one record at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.links import few
from holdfast.session import scratch_path, staged

# Payloads of fewer bytes are always written out.
LEAST = 100
# Payload groups larger than rows / HEAVY + HEAVY are joined by broadcast: there are fewer than HEAVY of them.
HEAVY = 10_000
# A record's date where the table has none.
DATE = "1970-01-01T00:00:00Z"

END = "\r\n\r\n"
RECORD = "page_id long, url string, date string, record_type string, payload_digest string, content_digest string, payload_bytes long, refers_to long, payload binary"


def _joined(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """`rows` left joined to the staged `groups` (key, members and values), however many rows one key has."""
    n = groups.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    bar = int(n) // HEAVY + HEAVY
    light, heavy = groups.where(f"members <= {bar}").drop("members"), groups.where(f"members > {bar}").drop("members")
    values = [c for c in light.columns if c != key]
    hot = heavy.select(key, F.struct(*values).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    # a settled row takes a null key into the shuffle join, spread by its id
    rest = marked.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)))
    easy, open_rows = rest.where("_key IS NULL"), rest.where("_key IS NOT NULL")
    done = easy.select(*rows.columns, *[F.col(f"_hot.{v}").alias(v) for v in values])
    return done.unionByName(open_rows.select(*rows.columns).join(light, key, "left").select(*rows.columns, *values))


def designated(pages: DataFrame) -> DataFrame:
    """Headers (page_id, digest, n, holder): each payload's digest and size, and the smallest page that has it.

    `holder` is null for payloads of fewer than LEAST bytes and where no page of the payload has an id.
    """
    headers = pages.select("page_id", F.sha2(_payload(), 256).alias("digest"), F.octet_length(_payload()).cast("long").alias("n"))
    headers = staged(headers, "headers")
    several = headers.where(f"n >= {LEAST}").groupBy("digest").agg(F.min("page_id").alias("holder"), F.count("*").alias("members"))
    several = staged(several.where("members > 1 AND holder IS NOT NULL"), "several")
    slim = headers.where(f"n >= {LEAST}").select("page_id", "digest").distinct()
    return _joined(slim, several, "digest").where("holder IS NOT NULL AND NOT (page_id <=> holder)")


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _short(digest: str) -> Column:
    """The digest's first 60 bits: enough beside a page's id."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)), F.lit(">"))


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One column `value`: the WARC record of each row of (page_id, url, html), without the line ends behind it.

    A revisit carries the HTTP head alone and names page, record and digest of the response. Control
    characters and blanks in an address are percent-encoded, as header lines cannot hold them.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    revisits = staged(designated(slim).select(F.col("page_id").alias("again"), _short("digest").alias("again_digest"), "holder"), "revisits")
    own = slim.withColumns({"n": F.octet_length(_payload()).cast("long"), "digest": F.sha2(_payload(), 256)})
    same = own["page_id"].eqNullSafe(F.col("again")) & (_short("digest") == F.col("again_digest"))
    told = own.join(few(revisits), same, "left")
    uri = F.expr(r"array_join(transform(split(url, ''), c -> CASE WHEN c <= ' ' OR c = '\u007f' THEN concat('%', lpad(hex(ascii(c)), 2, '0')) ELSE c END), '')")
    uri = F.when(F.col("url").rlike(r"[\x00-\x20\x7F]"), uri).otherwise(F.col("url"))
    again = F.col("holder").isNotNull()
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    body = F.when(again, F.lit("")).otherwise(F.coalesce(F.col("html"), F.lit("")))
    length = F.octet_length(head) + F.octet_length(body)
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(again, _urn(F.col("holder").cast("string"), F.col("digest")))),
        _line("WARC-Refers-To-Date", F.when(again, F.lit(date))),
        _line("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-Id", F.when(again, F.col("holder").cast("string"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), length.cast("string"), F.lit(END), head, body,
    )
    return told.select(text.alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """Writes the pages' records, revisits resolved, as gzip archives below `path`."""
    records(pages, date).write.option("lineSep", END).option("compression", "gzip").text(path)


class _Stream:
    """The bytes of an archive, out of pieces that END stood between."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.have = 0

    def add(self, piece: bytes) -> None:
        self.parts += [piece, END.encode()]
        self.have += len(piece) + len(END)

    def joined(self) -> bytes:
        if len(self.parts) > 1:
            self.parts = [b"".join(self.parts)]
        return self.parts[0] if self.parts else b""

    def drop(self, n: int) -> None:
        rest = self.joined()[n:]
        self.parts, self.have = ([rest] if rest else []), len(rest)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _record(fields: dict[str, str], block: bytes) -> tuple:
    payload = block[block.index(END.encode()) + len(END) :]
    number = lambda name: int(fields[name]) if name in fields else None
    revisit = fields["warc-type"] == "revisit"
    told = fields["warc-payload-digest"].removeprefix("sha256:")
    found = None if revisit else hashlib.sha256(payload).hexdigest()
    return (
        number("x-page-id"), fields.get("warc-target-uri"), fields.get("warc-date"), fields["warc-type"], told, found,
        None if revisit else len(payload), number("x-refers-to-page-id"), None if revisit else payload,
    )


def _parsed(names: list[str], most_bytes: int):
    """Tasks that put the pieces of archives (rows in file order) together to records."""
    every = [f.strip().split(" ")[0] for f in RECORD.split(",")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[f.strip().split(" ")[1]] for f in RECORD.split(",")]
    wanted = [every.index(n) for n in names]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in wanted], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, fields, need = _Stream(), None, 0
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for piece in batch.column(0).cast(pa.binary()):
                stream.add(piece.as_py())
                while True:
                    if fields is None:
                        data = stream.joined()
                        start = len(data) - len(data.lstrip(b"\r\n"))
                        if start == len(data):
                            stream.drop(start)
                            break
                        end = data.find(END.encode(), start)
                        if end < 0:
                            break
                        fields = _headers(data[start:end])
                        need = int(fields["content-length"])
                        stream.drop(end + len(END))
                    if stream.have < need:
                        break
                    block = stream.joined()[:need]
                    stream.drop(need)
                    record = _record(fields, block)
                    fields = None
                    rows.append(record)
                    size += need if "payload" in names else 0
                    if len(rows) >= 5000 or size >= most_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
        if fields is not None:
            raise ValueError(f"an archive ends inside a record: {need} bytes expected, {stream.have} there")
        if rows:
            yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, path: str, columns: list[str] | None = None, most_bytes: int = 8_000_000) -> DataFrame:
    """The records of archives: headers and, of responses, the payload with its own size and digest (columns of RECORD)."""
    every = [f.strip().split(" ")[0] for f in RECORD.split(",")]
    names = columns or every
    schema = ", ".join(f.strip() for f in RECORD.split(",") if f.strip().split(" ")[0] in names)
    names = [f.split(" ")[0] for f in schema.split(", ")]
    return spark.read.option("lineSep", END).text(path).mapInArrow(_parsed(names, most_bytes), schema)


def resolved(read: DataFrame) -> DataFrame:
    """Each record with size and digest of its full payload: revisits take them from the response they refer to."""
    slim = staged(read, "records")
    pointing = slim.where("record_type = 'revisit'")
    counts = pointing.groupBy("refers_to", "payload_digest").agg(F.count("*").alias("members"))
    originals = slim.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "content_digest", "payload_bytes").distinct()
    key = F.concat_ws(":", F.col("refers_to").cast("string"), F.col("payload_digest")).alias("_original")
    found = staged(counts.join(originals, ["refers_to", "payload_digest"]).select(key, "members", F.col("content_digest").alias("digest"), F.col("payload_bytes").alias("n")), "originals")
    named = pointing.select("page_id", "refers_to", key)
    revisits = _joined(named, found, "_original").selectExpr("page_id", "n AS payload_bytes", "digest AS payload_digest", "'revisit' AS record_type", "refers_to")
    return slim.where("record_type = 'response'").selectExpr("page_id", "payload_bytes", "content_digest AS payload_digest", "record_type", "refers_to").unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages' archives, reads them back, and returns one row per page: page_id, payload_bytes,
    payload_digest, record_type, refers_to.

    Payload is the html in UTF-8, null is empty. Of pages with equal payloads of LEAST bytes or more the
    one with the smallest id is the response and the others revisit it. Rows that repeat the smallest id are
    responses too; a page without id revisits one that has an id, and is a response where none has.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return resolved(read_archives(spark, path, ["page_id", "record_type", "payload_digest", "content_digest", "payload_bytes", "refers_to"]))


def oracle() -> str:
    """The registered query as DuckDB SQL."""
    return f"""
      WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
      f AS (SELECT *, CASE WHEN n >= {LEAST} THEN min(page_id) OVER (PARTITION BY digest) END AS holder FROM p)
      SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
        CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN holder <> page_id THEN holder END AS refers_to
      FROM f"""
