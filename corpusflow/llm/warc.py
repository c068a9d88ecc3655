"""WARC archives: writing, reading and transaction assembly (operator 10).

Records are read from whole archive files by their Content-Length. A capture
is the transaction of one page: its request and metadata records name the
response (or revisit) in WARC-Concurrent-To, and assembly groups the three by
that identifier into one nested row. Payloads do not travel: a response leaves
the reader as its length and digest unless the payload is asked for.

The writer turns each page into the three records of its capture in one row,
so they land in one file of one task attempt. It uses Spark's text writer, so
any store that Spark writes to will do; the blank line that ends a WARC record
is the writer's line separator.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import read, scratch, written

#: payloads of fewer bytes are always stored again
REVISIT_BYTES = 1000
#: rows in an archive file; the reader takes a file at a time
FILE_PAGES = 400
#: size of the table of repeated payloads up to which it is broadcast
BROADCAST_ROWS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"
#: packed bytes unpacked at a time
FEED = 1 << 16
#: bytes in which a record's headers must end
HEAD = 1 << 20
_GZIP = b"\x1f\x8b\x08"
_LINE_ENDS = re.compile(rb"[\r\n]*")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _record(kind: Column | str, rid: Column, headers: list, block: Column) -> Column:
    """One record up to, and without, the two line ends after its block."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), rid),
             F.lit(f"WARC-Date: {DATE}"), *(F.concat(F.lit(f"{n}: "), v) for n, v in headers),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    # concat_ws leaves out headers without a value
    return F.concat(F.concat_ws(_CRLF, *lines), F.lit(_CRLF * 2), block)


def plan_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``digest, n_bytes, first`` of payloads of ``least`` bytes or more that several pages have."""
    digests = pages.select("page_id", F.col("payload"), F.octet_length("payload").alias("n_bytes")).where(F.col("n_bytes") >= least) \
        .select("page_id", F.sha1(F.col("payload").cast("binary")).alias("digest"), "n_bytes")
    return (digests.groupBy("digest", "n_bytes").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and first is not null").select("digest", "n_bytes", "first"))


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Archives of ``pages(page_id, url, html)`` below ``path``.

    Of records with equal payloads of at least ``least`` bytes that with the
    largest page_id is a response and the others are revisits of it; all
    smaller ones are responses. A null html is an empty payload; a null url or
    page_id leaves its header out; a row without page_id is stored in full;
    rows that repeat a page and payload give a record each (with the same
    identifier). Other columns are not written.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]+", " ").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    again = written(plan_revisits(p, least).toDF("again_digest", "again_bytes", "first"), "warc-again")
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    p = p.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("n_bytes", F.octet_length("payload"))
    p = p.join(again, (p.digest == again.again_digest) & (p.n_bytes == again.again_bytes), "left")
    revisit = (F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") < F.col("first")))
    page, digest = F.col("page_id").cast("string"), F.concat(F.lit("sha1:"), F.col("digest"))
    rid = _urn(F.lit("capture"), F.coalesce(page, F.lit("")), F.col("digest"))
    uri = ("WARC-Target-URI", F.col("url"))
    head = F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}{_CRLF}")
    main = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), rid,
        [uri, ("WARC-Page-ID", page), ("WARC-Payload-Digest", digest),
         ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
         ("WARC-Refers-To", F.when(revisit, _urn(F.lit("capture"), F.col("first").cast("string"), F.col("digest")))),
         ("WARC-Refers-To-Page", F.when(revisit, F.col("first").cast("string"))),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(revisit, head).otherwise(F.concat(head, F.col("payload"))))
    request = _record("request", _urn(F.lit("request"), rid), [uri, ("WARC-Concurrent-To", rid),
                                                               ("Content-Type", F.lit("application/http;msgtype=request"))],
                      F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(f" HTTP/1.1{_CRLF}{_CRLF}")))
    meta = _record("metadata", _urn(F.lit("metadata"), rid), [uri, ("WARC-Concurrent-To", rid),
                                                              ("Content-Type", F.lit("application/warc-fields"))],
                   F.concat(F.lit("payload-length: "), F.col("n_bytes").cast("string"), F.lit(_CRLF)))
    (p.select(F.concat_ws(_CRLF * 2, request, main, meta).alias("value"))
     .write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_PAGES).text(path))


def unpack(data: bytes):
    """An archive file's bytes in blocks; gzip files may have a member for each
    record. None stands where bytes are lost: a damaged or torn member, after
    which the next one that can be read goes on."""
    if data[:2] != _GZIP[:2]:
        yield from (data[at:at + FEED] for at in range(0, len(data), FEED))
        return
    at, view = 0, memoryview(data)
    while at < len(data):
        z, start = zlib.decompressobj(31), at
        try:
            while not z.eof and at < len(data):
                if block := z.decompress(view[at:at + FEED]):
                    yield block
                at = min(at + FEED, len(data))
        except zlib.error:
            yield None
            at = data.find(_GZIP, start + 1)
            if at < 0:
                return
            continue
        if not z.eof:
            yield None
            return
        at -= len(z.unused_data)
        while data[at:at + 1] == b"\0":
            at += 1


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split(_CRLF)[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def records(blocks):
    """(headers with lower-case names, block) of each record of the unpacked
    ``blocks``, and (None, b"") for each damaged stretch: what is no record, is
    torn, or is not followed by a line end or a record. Reading goes on at the
    next place that begins like a record. One record is held at a time."""
    buf, lost, need = bytearray(), False, 0
    for block in chain(blocks, [b""]):
        last = not block  # nothing that follows belongs to what is there
        buf += block or b""
        while len(buf) >= need or last:
            del buf[:_LINE_ENDS.match(buf).end()]
            need = 0
            if not buf or not last and len(buf) < 5:
                break
            headers, stop, found = None, -1, buf.startswith(b"WARC/")
            end = buf.find(b"\r\n\r\n") if found else -1
            if found and end < 0 and not last and len(buf) < HEAD:
                need = len(buf) + 1
                break
            if end >= 0 and buf.find(b"\nWARC/1.", 1, end) < 0:  # else the headers are torn
                headers = _headers(bytes(buf[:end]))
                size = headers.get("content-length", "")
                stop = end + 4 + int(size) if size.isdigit() else -1
            if stop >= 0 and not last and len(buf) < stop + 5:
                need = stop + 5
                break
            if 0 <= stop <= len(buf) and (stop == len(buf) or buf[stop] in b"\r\n" or buf.startswith(b"WARC/", stop)):
                yield headers, bytes(buf[end + 4:stop])
                del buf[:stop]
                lost = False
                continue
            if not lost:
                yield None, b""
                lost = True
            at = buf.find(b"WARC/1.", 1)
            if at < 0 and not last:
                del buf[:-6]  # the start of a record may be torn
                need = len(buf) + 1
                break
            del buf[:at if at >= 0 else len(buf)]
        if block is None and not lost:
            yield None, b""
            lost = True


def parse(data):
    """The undamaged records of ``data``, an archive's bytes or blocks of it."""
    return (r for r in records([data] if isinstance(data, bytes) else data) if r[0] is not None)


_FIELDS = {"warc-type": "kind", "warc-record-id": "record_id", "warc-concurrent-to": "concurrent_to", "warc-target-uri": "url",
           "warc-date": "date", "warc-payload-digest": "stated_digest", "warc-page-id": "page", "warc-refers-to-page": "refers_to"}


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of the ``.warc``, ``.txt`` and gzipped archives below ``path``.

    ``kind, record_id, concurrent_to, url, date, stated_digest, page,
    refers_to, payload_bytes, payload_digest, fields, error[, payload]``: absent
    headers are null; length and bare SHA-1 are those of the HTTP body of
    responses and of the whole block of other records; ``fields`` is the block
    of a metadata record. Damaged ends of files are left out.
    """
    names = [*_FIELDS.values(), "payload_bytes", "payload_digest", "fields", "error", *["payload"] * payload]
    types = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def rows(data):
        for h, body in records(unpack(data)):
            if h is None:
                yield dict.fromkeys(names) | {"error": "damaged"}
                continue
            if h.get("content-type", "").startswith("application/http"):
                body = body.partition(b"\r\n\r\n")[2]
            row = {c: h.get(k) for k, c in _FIELDS.items()}
            row |= {"payload_bytes": len(body), "payload_digest": hashlib.sha1(body).hexdigest(),
                    "fields": body.decode("utf-8", "replace") if h.get("warc-type") == "metadata" else None, "error": None}
            yield row | ({"payload": body} if payload else {})

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                part = []
                for row in rows(b.column(0)[k].as_py()):
                    part.append(row)
                    if len(part) == 256:
                        yield _batch(part)
                        part = []
                yield _batch(part)

    def _batch(part):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in part], types.get(n, pa.string())) for n in names], names=names)

    kinds = {"payload_bytes": "long", "payload": "binary"}
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
            .mapInArrow(run, ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)))


def assemble(records: DataFrame) -> DataFrame:
    """``capture_id, request, captures, metadata``: one nested row per capture.

    The records of a transaction share the response's (or revisit's) record
    id: their own, or the one they are concurrent to. ``captures`` holds the
    response or revisit records (several only where an archive repeats a
    record), ``request`` and ``metadata`` the others; absent ones are null or
    empty. Records without any identifier are left out.
    """
    key = F.coalesce("concurrent_to", "record_id")
    whole = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    of = lambda *kinds: F.collect_list(F.when(F.col("kind").isin(*kinds), whole))
    return (records.where(key.isNotNull()).groupBy(key.alias("capture_id"))
            .agg(F.get(of("request"), F.lit(0)).alias("request"), of("response", "revisit").alias("captures"),
                 of("metadata").alias("metadata")))


def captures(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each capture of ``records``.

    A revisit's payload is that of the response it refers to: its digest is the
    one it states, its length that of the metadata record of its transaction.
    """
    one = assemble(records).select(F.explode("captures").alias("c"), F.get("metadata", F.lit(0))["fields"].alias("fields"))
    revisit = F.col("c.kind") == "revisit"
    told = F.regexp_extract("fields", r"payload-length: (\d+)", 1).cast("long")
    return one.select(F.col("c.page").cast("long").alias("page_id"),
                      F.when(revisit, told).otherwise(F.col("c.payload_bytes")).alias("payload_bytes"),
                      F.when(revisit, F.regexp_replace("c.stated_digest", "^sha1:", "")).otherwise(F.col("c.payload_digest"))
                      .alias("payload_digest"),
                      F.col("c.kind").alias("record_type"), F.col("c.refers_to").cast("long").alias("refers_to"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    return captures(read_warc(spark, path))


QUERIES = {"op10_warc": op10_warc}
ORACLE = {"op10_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to FROM q
"""}
