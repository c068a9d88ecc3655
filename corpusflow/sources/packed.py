"""Records of packed files (SRC13): xz, gz and zip, as a batch source.

An archive is decompressed as a stream, a block at a time, and cut into records
at a separator, so neither an archive nor what it unpacks to is held whole; the
longest record is. A zip file is one task a member, others one task a file. The
driver lists the folder and reads the directories of zip files, no data.

Register with ``spark.dataSource.register(PackedRecords)`` and read with
``spark.read.format("packed_records").option("path", root)``; further options
are ``sep`` (a line end) and ``encoding`` (UTF-8). Columns: ``source_path`` (the
file, then the member's path in it), ``record_no`` from 0, ``value`` and
``error``. Damaged data give one row with ``error`` and no value, after the
records that come before the damage; so does a member that needs a password.
Empty files and members have no records. Bytes that are not of the encoding
become U+FFFD.
"""

from __future__ import annotations

import codecs
import gzip
import lzma
import zipfile
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusflow.sources.catalog import COMPRESSIONS
from corpusflow.sources.follow import BLOCK, _filesystem

RECORDS = pa.schema([("source_path", pa.string()), ("record_no", pa.int64()), ("value", pa.string()), ("error", pa.string())])
#: what damaged or protected data raise
DAMAGE = (lzma.LZMAError, zlib.error, zipfile.BadZipFile, EOFError, gzip.BadGzipFile, pa.ArrowInvalid, RuntimeError, NotImplementedError)


@dataclass
class Packed(InputPartition):
    """One stream: a member of a zip file (by its place in the directory, as names may repeat), or a file."""
    file: str
    member: int | None
    name: str
    error: str | None = None


def unpacked(f, part: Packed):
    """The stream's bytes in blocks."""
    if part.member is not None:
        with zipfile.ZipFile(f) as z, z.open(z.infolist()[part.member]) as data:
            while block := data.read(BLOCK):
                yield block
        return
    with (lzma.open if part.file.endswith(".xz") else gzip.open)(f) as data:
        # what is ready now, so that all before damaged data comes out
        while block := data.read1(BLOCK):
            yield block


def records(blocks, sep: str, encoding: str):
    """Lists of the records that end in each block; the last need not end."""
    decoder, rest = codecs.getincrementaldecoder(encoding)("replace"), []
    tail = ""
    for block in blocks:
        text = tail + decoder.decode(block)
        *done, text = text.split(sep)
        if done:
            done[0], rest = "".join([*rest, done[0]]), []
            yield done
        # a separator may be torn: its first part waits
        keep = len(sep) - 1
        cut = max(len(text) - keep, 0)
        rest.append(text[:cut])
        tail = text[cut:]
    if last := "".join([*rest, tail, decoder.decode(b"", True)]):
        yield [last]


class PackedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.sep, self.encoding = options.get("sep", "\n"), options.get("encoding", "utf-8")

    def partitions(self) -> list[Packed]:
        from pyarrow import fs
        system, root = _filesystem(self.root)
        info = system.get_file_info(root)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if info.type == fs.FileType.Directory else [info]
        out = []
        for path in sorted(x.path for x in found if x.type == fs.FileType.File and x.extension in COMPRESSIONS):
            if not path.endswith(".zip"):
                out.append(Packed(path, None, path))
                continue
            try:
                with system.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                    out += [Packed(path, i, f"{path}/{m.filename}") for i, m in enumerate(z.infolist()) if not m.is_dir()]
            except (zipfile.BadZipFile, pa.ArrowInvalid) as e:  # a short file has no place to look for the directory
                out.append(Packed(path, None, path, str(e)))
        # Spark asks for one at least
        return out or [Packed("", None, "")]

    def read(self, part: Packed):
        def batch(first: int, values: list, error: str | None = None):
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([part.name] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                 pa.array(values, pa.string()), pa.array([error] * n, pa.string())], schema=RECORDS)

        n = 0
        if part.error:
            yield batch(0, [None], part.error)
        elif part.file:
            system, _ = _filesystem(self.root)
            with system.open_input_file(part.file) as f:
                damage: list[str] = []
                for values in records(_until_damage(unpacked(f, part), damage), self.sep, self.encoding):
                    yield batch(n, values)
                    n += len(values)
                if damage:
                    yield batch(n, [None], damage[0])


def _until_damage(blocks, damage: list):
    try:
        yield from blocks
    except DAMAGE as e:
        damage.append(f"{type(e).__name__}: {e}")


class PackedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "packed_records"

    def schema(self) -> str:
        return "source_path string, record_no long, value string, error string"

    def reader(self, schema) -> PackedReader:
        return PackedReader(dict(self.options))


def read_packed(spark: SparkSession, path: str, sep: str = "\n", encoding: str = "utf-8") -> DataFrame:
    """Records of every xz, gz and zip file at ``path`` or below."""
    spark.dataSource.register(PackedRecords)
    return spark.read.format("packed_records").options(path=path, sep=sep, encoding=encoding).load()
