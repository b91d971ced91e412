"""Operator 10: web archives whose repeated payloads are revisit records."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, table, written

#: Payloads of fewer bytes are always stored as responses.
LEAST_BYTES = 1000
#: Bytes of payloads that one archive file holds at most (or a single larger payload), so that a reader's task holds a bounded file.
FILE_BYTES = 128 << 20
#: Pages are written in classes of payloads of up to so many bytes, then CLASS times as many, and so on: a full file of a class holds
#: at least FILE_BYTES / CLASS but in the first, and one large page makes no other page's file smaller.
SMALL_BYTES, CLASS = 32 << 10, 8
#: Pages of one payload, and their share of all pages, over which they meet the page that they repeat by broadcast.
COMMON, COMMON_SHARE = 1000, 0.001
DATE = "2020-01-01T00:00:00Z"
END = "\r\n\r\n"


def with_digests(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload (null: empty), payload_bytes and payload_digest (hex SHA-1) of each row."""
    payload = F.coalesce(F.col(html), F.lit(""))
    some = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    return some.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1(F.encode("payload", "UTF-8"))})


def revisits(headers: DataFrame, least_bytes: int = LEAST_BYTES, common: int = COMMON) -> DataFrame:
    """Rows (page_id, payload_digest, payload_bytes, origin, origin_url) of the pages that repeat another page's payload.

    Only headers are shuffled, by digest and length; the page with the largest id keeps its payload, the rest refer to it. Payloads of
    more than `common` pages (the caller's bound on their number is all pages / common) meet their pages by broadcast, not in a task.
    """
    keys = ["payload_digest", "payload_bytes"]
    large = headers.where(F.col("payload_bytes") >= least_bytes).select("page_id", "url", *keys)
    origins = large.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("o")).where("n > 1 and o.page_id is not null")
    often = F.broadcast(origins.where(F.col("n") > common).select(*keys, F.col("o").alias("often")))
    dealt = large.join(often, keys, "left")
    rest = dealt.where("often is null").drop("often").join(origins.where(F.col("n") <= common), keys)
    met = dealt.where("often is not null").select("page_id", *keys, F.col("often").alias("o")).unionByName(rest.select("page_id", *keys, "o"))
    found = met.where(~F.col("page_id").eqNullSafe(F.col("o.page_id")))
    return found.select("page_id", *keys, F.col("o.page_id").alias("origin"), F.col("o.url").alias("origin_url")).distinct()


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.sha1(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), digest).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.lit("8"), part(18, 3)), part(21, 12)), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line breaks and other control characters in values are percent-coded."""
    safe = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """One column, record: the WARC/1.1 text of each row of (page_id, url, payload, payload_bytes, payload_digest, origin, origin_url)."""
    again = F.col("origin").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(date)),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(again, _record_id(F.col("origin"), F.col("payload_digest")))),
        _line("WARC-Refers-To-Target-URI", F.when(again, F.col("origin_url"))),
        _line("WARC-Refers-To-Date", F.when(again, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    return pages.select(F.concat(head, block).alias("record"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = DATE, **columns: str) -> None:
    """Write each row of pages as a record of gzipped archives under path; equal payloads of `least_bytes` or more are stored once.

    Payloads stay where they were read unless many pages repeat others: the list of revisits, headers only, is written first, and
    Spark broadcasts it if its size allows, else joins by page id, over which no payload is common. The text writer ends each
    record with the two line breaks that the format asks for.

    Files are bounded in bytes: pages are written by classes of their size, each with its own number of records to a file.

    Null html is an empty payload; a null url has no target header; a null page_id has no id header, is never an original beside
    pages with ids, and revisits them; rows that repeat the largest id of their payload are all responses; an empty table gives no
    archive; other columns are ignored.
    """
    all_of_it = with_digests(pages, **columns)
    n, most = all_of_it.agg(F.count("*"), F.coalesce(F.max("payload_bytes"), F.lit(0))).first()
    again = written(revisits(all_of_it, least_bytes, max(COMMON, int(COMMON_SHARE * n))), "revisits")
    on = all_of_it["page_id"].eqNullSafe(again["page_id"]) & (all_of_it["payload_digest"] == again["payload_digest"]) & (all_of_it["payload_bytes"] == again["payload_bytes"])
    dealt = all_of_it.join(again, on, "left").select(all_of_it["*"], again["origin"], again["origin_url"])
    bounds = [SMALL_BYTES]
    while bounds[-1] < most:
        bounds.append(bounds[-1] * CLASS)
    size_class = sum((F.col("payload_bytes") > x).cast("int") for x in bounds)
    there = [r[0] for r in all_of_it.select(size_class.alias("c")).distinct().collect()] if len(bounds) > 1 else [0]
    for c in sorted(there) or [0]:
        some = dealt.where(size_class == c) if len(bounds) > 1 else dealt
        out = records(some, date).write.option("lineSep", END).option("compression", "gzip")
        out.option("maxRecordsPerFile", max(1, FILE_BYTES // bounds[c])).text(f"{path}/large/upto-{bounds[c]}" if c else f"{path}/small")


FIELDS = "record_id string, type string, page_id long, uri string, date string, declared_digest string, refers_to_id string, payload_bytes long, payload_digest string"


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of one gzipped archive, of one or many gzip members."""
    with io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)), 1 << 20) as f:
        while line := f.readline():
            if not line.startswith(b"WARC/"):
                if line.strip():
                    raise ValueError("a record doesn't begin where the one before it ends")
                continue
            head = {}
            while (line := f.readline().rstrip(b"\r\n")):
                name, _, value = line.partition(b":")
                head[name.decode().strip().lower()] = value.decode().strip()
            block = f.read(int(head["content-length"]))
            if len(block) < int(head["content-length"]):
                raise ValueError("a record is cut off")
            yield head, block


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row for each record of the archives: its headers, payload_bytes and payload_digest (of the stored payload; null for
    revisits), and the payload unless payload=False. A file goes to one task; write_warc bounds its bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                rows: list[list] = []
                for head, block in parse_warc(raw.as_py()):
                    kind, body = head.get("warc-type"), block.partition(b"\r\n\r\n")[2]
                    own = kind != "revisit"
                    digest = head.get("warc-payload-digest", "")
                    at = head.get("x-page-id")
                    rows.append([head.get("warc-record-id"), kind, None if at is None else int(at), head.get("warc-target-uri"), head.get("warc-date"), digest.removeprefix("sha1:") or None, head.get("warc-refers-to"), len(body) if own else None, hashlib.sha1(body).hexdigest() if own else None, *([body if own else None] * payload)])
                    if len(rows) >= 1000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), *([pa.binary()] * payload)]
    names = [x.split()[0] for x in FIELDS.split(", ")] + ["payload"] * payload

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files.mapInArrow(read, FIELDS + (", payload binary" if payload else ""))


def resolved(archive: DataFrame) -> DataFrame:
    """Join each revisit to the response it refers to: payload_bytes, payload_digest and the response's page_id as refers_to."""
    kept = archive.where("type <> 'revisit'")
    origin = kept.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d")).dropDuplicates(["refers_to_id"])
    again = archive.where("type = 'revisit'").drop("payload_bytes", "payload_digest").join(origin, "refers_to_id", "left")
    columns = ["page_id", "uri", "record_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"]
    return kept.withColumn("refers_to", F.lit(None).cast("long")).select(*columns).unionByName(again.withColumnsRenamed({"b": "payload_bytes", "d": "payload_digest"}).select(*columns))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page what the archives hold of it, as read back from them."""
    path = new_path(spark, "archives")
    write_warc(table(spark, sf_dir, "pages"), path)
    found = resolved(written(read_warc(spark, path, payload=False), "archive-index"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(encode(html)) AS payload_digest FROM p),
o AS (SELECT payload_digest, max(page_id) AS origin FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN o.origin <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN o.origin <> d.page_id THEN o.origin END AS refers_to
FROM d LEFT JOIN o ON d.payload_digest = o.payload_digest AND d.payload_bytes >= 1000
"""
