import gzip
import hashlib

from corpusflow.llm import warc as A
from corpusflow.llm.common import scratch


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], "page_id long, url string, html string, digest string, kind string")


LONG = "<p>" + "é" * 600 + "</p>"
ROWS = [(1, "http://a", LONG), (5, "http://b", LONG), (3, None, LONG), (7, "http://c", "short"), (8, "http://d", "short"), (9, "http://e", None),
        (10, "http://f\r\nX: y", "a\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 30), (11, "", ""),
        (12, "http://g", "x" * 999), (13, "http://g", "x" * 999), (14, "http://g", "y" * 1000), (15, "http://g", "y" * 1000),
        (20, "http://h", "z" * 2000), (20, "http://h", "z" * 2000), (None, "http://i", LONG), (30, "http://j", "w" * 300_000)]


def want(rows):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == raw]
        top = max(same, default=None)
        again = len(raw) >= 1000 and i is not None and i < top
        out.append((str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    path = scratch(spark, "test-warc")
    A.write_warc(pages(spark, ROWS), path)
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in A.captures(A.read_warc(spark, path)).collect()]
    assert sorted(got, key=str) == want(ROWS)
    stored = {bytes(r.payload) for r in A.read_warc(spark, path, payload=True).where("kind = 'response'").collect()}
    assert stored == {(h or "").encode() for _, _, h in ROWS}
    one = A.assemble(A.read_warc(spark, path)).where("size(captures) = 1").collect()
    assert all(r.request.kind == "request" and len(r.metadata) == 1 and r.captures[0].record_id == r.capture_id for r in one) and len(one) > 10


def test_repeated_payloads_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_ROWS", 0)
    path = scratch(spark, "test-warc")
    A.write_warc(pages(spark, ROWS), path)
    assert A.captures(A.read_warc(spark, path)).where("record_type = 'revisit'").count() == 3


def test_empty_table(spark):
    path = scratch(spark, "test-warc")
    A.write_warc(pages(spark, []), path)
    assert A.captures(A.read_warc(spark, path)).count() == 0


def test_records_of_other_writers():
    rec = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    members = b"".join(gzip.compress(rec) for _ in range(3))
    assert [bytes(b) for _, b in A.parse(A.unpack(members))] == [b"abc"] * 3
    assert len(list(A.parse(rec + rec[:-8]))) == 1 and list(A.parse(b"")) == [] and list(A.parse(b"junk")) == []


def record(n, body=b"abc"):
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: %d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, len(body), body)


def read(blocks):
    return [h["warc-record-id"] if h else None for h, _ in A.records(blocks)]


def test_damaged_records_are_told_and_passed():
    good = [record(i, b"x" * 50) for i in range(4)]
    torn = record(9, b"y" * 50)[:-20]
    for size in (1, 3, 7, 64, 1 << 20):
        cut = lambda data: [data[i:i + size] for i in range(0, len(data), size)]
        assert read(cut(b"".join(good))) == ["0", "1", "2", "3"]
        # cut in its block, a wrong length, no headers' end, junk between, junk at the end
        assert read(cut(good[0] + torn + good[1] + good[2])) == ["0", None, "1", "2"]
        assert read(cut(good[0] + good[1].replace(b"h: 50", b"h: 20") + good[2])) == ["0", None, "2"]
        assert read(cut(good[0] + good[1].replace(b"h: 50", b"h: many") + good[2])) == ["0", None, "2"]
        assert read(cut(good[0] + b"junk\r\n\r\njunk\r\n" + good[1] + torn)) == ["0", None, "1", None]
        assert read(cut(torn)) == [None] and read(cut(b"\r\n\r\n")) == []


def test_damaged_members():
    # bodies that hardly pack, so that damage lies in their data
    members = [gzip.compress(record(i, hashlib.sha512(bytes([i])).hexdigest().encode())) for i in range(4)]
    assert read(A.unpack(b"".join(members))) == ["0", "1", "2", "3"]
    broken = bytearray(members[1])
    broken[40] ^= 0xFF
    got = read(A.unpack(members[0] + bytes(broken) + members[2] + members[3]))
    assert got[0] == "0" and None in got and got[-2:] == ["2", "3"]
    assert read(A.unpack(members[0] + members[1][:-30])) == ["0", None]
    assert read(A.unpack(members[0] + b"trailing" + members[1])) == ["0", None, "1"]


def test_error_rows(spark):
    import os
    path = scratch(spark, "test-warc").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/a.warc", "wb") as f:
        f.write(record(1) + record(2)[:-9] + record(3))
    rows = A.read_warc(spark, path).collect()
    assert [(r.record_id, r.error) for r in rows] == [("1", None), (None, "damaged"), ("3", None)]
    assert A.captures(A.read_warc(spark, path)).count() == 2


def test_a_large_member_is_unpacked_in_pieces():
    data = gzip.compress(b"".join(record(i, b"z" * 1000) for i in range(20_000)))
    assert max(len(b) for b in A.unpack(data)) < 80 << 20
    assert read(A.unpack(data)) == [str(i) for i in range(20_000)]
