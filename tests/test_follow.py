"""Logs that grow: ranges of bytes, lines not ended yet, appended, new and replaced files."""

import io

import pytest

from corpusflow.sources import follow as W
from corpusflow.streaming import monitor as M


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 20])
def test_ranges_read_every_line_once(monkeypatch, block):
    monkeypatch.setattr(W, "BLOCK", block)
    text = b"one\n\ntwo words\r\n" + "lông".encode() * 9 + b"\n\n\nx\nhalf"
    whole = W.whole_lines(io.BytesIO(text), len(text))
    assert whole == len(text) - 4
    want, at = [], 0
    for line in text[:whole].split(b"\n")[:-1]:
        want.append((at, line))
        at += len(line) + 1
    for first in (0, want[2][0], want[-1][0]):
        for split in (1, 2, 5, 16, 1000):
            got = []
            for s in range(first, whole, split):
                for starts, lines in W.lines_of(io.BytesIO(text), W.Range("f", first, s, min(s + split, whole), whole)):
                    got += zip(starts, lines)
            assert got == [x for x in want if x[0] >= first], (first, split)


def test_no_line_end_yet():
    assert W.whole_lines(io.BytesIO(b"x" * 200_000), 200_000) == 0
    assert W.whole_lines(io.BytesIO(b"a\n" + b"x" * 200_000), 200_002) == 2


def test_replaced_file_is_read_from_its_start():
    r = W.FollowReader({"path": "/nowhere", "splitBytes": "10"})
    assert r.latestOffset() == r.initialOffset() == {}
    parts = r.partitions({"a": 25, "b": 30, "gone": 5}, {"a": 30, "b": 12, "c": 4})
    assert [(p.file, p.first, p.start, p.stop, p.end) for p in parts] == [
        ("a", 25, 25, 30, 30), ("b", 0, 0, 10, 12), ("b", 0, 10, 12, 12), ("c", 0, 0, 4, 4)]


def test_stream_reads_on(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    (root / "job=a b").mkdir(parents=True)

    def drain():
        q = (M.followed_stream(spark, str(root), split_bytes=5).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.job, r.at, r.value) for r in spark.read.parquet(out).collect())

    log, other = root / "job=a b" / "x.log", root / "c.log"
    log.write_text("first\nsecond\nthi")
    (root / "job=a b" / "x.txt").write_text("no log\n")
    assert drain() == [("a b", 0, "first"), ("a b", 6, "second")]
    assert len(drain()) == 2
    with log.open("a") as f:
        f.write("rd\nfourth\n")
    other.write_text("new\n")
    assert drain() == [("a b", 0, "first"), ("a b", 6, "second"), ("a b", 13, "third"), ("a b", 19, "fourth"), ("in", 0, "new")]
