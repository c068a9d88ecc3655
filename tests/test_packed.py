import gzip
import lzma
import os
import zipfile

import pytest

from corpusflow.plans.fixtures import scratch_dir
from corpusflow.sources import bitext, packed

TU = '<tu><tuv xml:lang="en"><seg>{}</seg></tuv><tuv xml:lang="cy"><seg>{}</seg></tuv></tu>'


@pytest.fixture()
def root(spark):
    path = scratch_dir(spark, "t-packed").removeprefix("file:")
    os.makedirs(f"{path}/Health")
    return path


def lines(spark, root, **options):
    rows = packed.read_packed(spark, root, **options).collect()
    return sorted((r.source_path.removeprefix(root + "/"), r.record_no, r.value, r.error) for r in rows)


def test_members_and_streams(spark, root):
    with lzma.open(f"{root}/a.txt.xz", "wb") as f:
        f.write("ŵyn\n\nlast".encode())
    with open(f"{root}/b.txt.gz", "wb") as f:  # two members, a character and a record across them
        f.write(gzip.compress(b"one\ntw" + "ô".encode()[:1]) + gzip.compress("ô".encode()[1:] + b"\n"))
    with zipfile.ZipFile(f"{root}/c.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/1.txt", "1\n2\n")
        z.writestr("x/empty.txt", "")
        z.writestr("y/2.txt", "3")
    with open(f"{root}/d.txt", "w") as f:
        f.write("not packed\n")
    assert lines(spark, root) == [
        ("a.txt.xz", 0, "ŵyn", None), ("a.txt.xz", 1, "", None), ("a.txt.xz", 2, "last", None),
        ("b.txt.gz", 0, "one", None), ("b.txt.gz", 1, "twô", None),
        ("c.zip/x/1.txt", 0, "1", None), ("c.zip/x/1.txt", 1, "2", None), ("c.zip/y/2.txt", 0, "3", None)]
    assert packed.read_packed(spark, root).rdd.getNumPartitions() == 5


def test_other_encoding(spark, root):
    with gzip.open(f"{root}/a.gz", "wb") as f:
        f.write("à\r\nb\r\n".encode("utf-16"))
    assert [x[2] for x in lines(spark, root, sep="\r\n", encoding="utf-16")] == ["à", "b"]


def test_damage_is_told(spark, root):
    data = "".join(f"line {i} {i * 7919 % 10007}\n" for i in range(200_000)).encode()
    whole = {"x.xz": lzma.compress(data), "g.gz": gzip.compress(data)}
    for name, raw in whole.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(raw[:len(raw) // 2])
    with open(f"{root}/z.zip", "wb") as f:
        f.write(b"PK no archive")
    open(f"{root}/none.gz", "wb").close()
    rows = lines(spark, root)
    for name in ("g.gz", "x.xz"):
        mine = [r for r in rows if r[0] == name]
        assert mine[-1][3] and mine[-1][2] is None and [r[1] for r in mine] == list(range(len(mine)))
        assert len(mine) > 50_000 and all(r[2] == f"line {i} {i * 7919 % 10007}" for i, r in enumerate(mine[:-2]))
    assert [(r[0], r[2]) for r in rows if r[0][0] in "zn"] == [("z.zip", None)]


def test_no_archives(spark, root):
    assert packed.read_packed(spark, root).count() == 0


def test_torn_separators():
    for size in (1, 2, 3, 7):
        text = "a</tu>b</t</tu></tu>c</tu"
        blocks = [text.encode()[i:i + size] for i in range(0, len(text), size)]
        assert [r for part in packed.records(blocks, "</tu>", "utf-8") for r in part] == ["a", "b</t", "", "c</tu"]


def test_packed_tmx(spark, root):
    body = "<tmx><body>" + TU.format("One", "Un") + "\n" + TU.format("bad &nowhere;", "x") + "</body></tmx>"
    with lzma.open(f"{root}/Health/m.tmx.xz", "wb") as f:
        f.write(body.encode())
    with zipfile.ZipFile(f"{root}/all.zip", "w") as z:
        z.writestr("Other/n.tmx", TU.format("Two", "Dau"))
    with open(f"{root}/Health/torn.tmx.gz", "wb") as f:
        f.write(b"\x1f\x8b\x08 torn")
    rows = bitext.with_label(bitext.packed_tmx_units(spark, root)).collect()
    assert sorted((r.classifier, r.source, r.target, r.reject_reason) for r in rows if r.source and not r.reject_reason) == [
        ("Health", "One", "Un", None), ("Other", "Two", "Dau", None)]
    assert sorted(r.reject_reason for r in rows if r.reject_reason) == ["damaged", "malformed"]
    assert bitext.read_packed_tmx(spark, root).count() == 2


def test_packed_files_grow_with_the_units(spark, root, monkeypatch):
    from collections import Counter
    from pathlib import Path

    from corpusflow.plans import fixtures as FX
    from corpusflow.sources import bitext
    rows = [(i, "A" if i % 4 else "B c", f"s {i}", f"t {i}", "en", "cy") for i in range(1, 601)]
    f1 = spark.createDataFrame(rows, "line_no long, classifier string, source string, target string, source_lang string, target_lang string")
    monkeypatch.setattr(FX, "PACKED_UNITS", 20)
    FX.write_packed_tree(f1, f"{root}/grown")
    kinds = Counter(f.suffix for f in Path(f"{root}/grown".removeprefix("file:")).rglob("*.*"))
    assert kinds == {".xz": 20, ".gz": 20, ".zip": 10}
    got = bitext.with_label(bitext.read_packed_tmx(spark, f"{root}/grown"))
    assert sorted((r.classifier, r.target) for r in got.collect()) == sorted((c, t) for _, c, _, t, *_ in rows)
