"""ZIP archives expanded inside the executors, a member at a time.

One job reads the directories of all archives. Each member is then a task's own work: the task seeks to the member
and unpacks it piece by piece, so an archive of many members keeps as many cores busy, and neither an archive nor a
member has to fit into memory. Members come out as blocks of whole lines; blocks are spread again before Spark's own
CSV parser sees them. An archive that cannot be read gives a row with its error, and the others stay.

A file system that only Spark's readers know gives no part of a file to a task. Archives there are read as a whole,
up to Spark's limit for the content of a file.
"""

from __future__ import annotations

import io
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from aduana.session import fresh_path
from aduana.sources.delimited import ENCODING
from aduana.sources.opening import opened, tasks_can_open

# The functions below travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER_SCHEMA = (
    "path string, member string, offset long, packed long, size long, checksum long, method int, flags int, error string"
)
BLOCK_SCHEMA = "path string, member string, block string, error string"
BLOCK_CHARS = 1 << 20
#: Packed bytes that are read at once.
READ_BYTES = 1 << 18


def _line_blocks(stream, encoding: str) -> Iterator[str]:
    """Text up to a line end, about `BLOCK_CHARS` at a time; only \\r and \\n end a line."""
    rest: list[str] = []
    reader = io.TextIOWrapper(stream, encoding=encoding, newline=None)
    while chunk := reader.read(BLOCK_CHARS):
        end = chunk.rfind("\n")
        if end < 0:
            rest.append(chunk)
            continue
        yield "".join([*rest, chunk[:end]])
        rest = [chunk[end + 1:]]
    if last := "".join(rest):
        yield last


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    types = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[k] for k in kinds]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def _told(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def archive_members(files: DataFrame) -> DataFrame:
    """The directory of every archive in `files`: (path, member, offset, packed, size, checksum, method, flags, error).

    Only the directory at the end of an archive is read. One that cannot be read is a row with its error.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with opened(path) as raw, zipfile.ZipFile(raw) as archive:
                        found = [
                            (path, m.filename, m.header_offset, m.compress_size, m.file_size, m.CRC, m.compress_type,
                             m.flag_bits, None)
                            for m in archive.infolist() if not m.is_dir()
                        ]
                    yield _rows(MEMBER_SCHEMA, found)
                except Exception as error:  # noqa: BLE001 - told per archive
                    yield _rows(MEMBER_SCHEMA, [(path, *[None] * 7, _told(error))])

    return files.select("path").mapInArrow(listed, MEMBER_SCHEMA)


class _Member(io.RawIOBase):
    """Unpacked bytes of one stored or deflated member, read from where it stands; its checksum is verified."""

    def __init__(self, raw, offset: int, packed: int, size: int, checksum: int, method: int):
        raw.seek(offset)
        head = raw.read(30)
        if head[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile("no member where the directory says")
        raw.seek(offset + 30 + sum(struct.unpack_from("<HH", head, 26)))
        self.raw_stream, self.left, self.size, self.checksum = raw, packed, size, checksum
        self.unpacker = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        self.held, self.sum, self.count = b"", 0, 0

    def readable(self) -> bool:
        return True

    def _more(self) -> bytes:
        """The next unpacked bytes; none at the end."""
        while self.unpacker is None or not self.unpacker.eof:
            tail = self.unpacker.unconsumed_tail if self.unpacker else b""
            chunk = tail or self.raw_stream.read(min(self.left, READ_BYTES))
            if not tail:
                self.left -= len(chunk)
            if self.unpacker is None:
                return chunk
            if not chunk:
                break
            if out := self.unpacker.decompress(chunk, 4 * READ_BYTES):
                return out
        return b""

    def readinto(self, buffer) -> int:
        if not self.held:
            self.held = self._more()
            self.sum = zlib.crc32(self.held, self.sum)
            self.count += len(self.held)
            if not self.held and (self.count != self.size or self.sum != self.checksum):
                raise zipfile.BadZipFile("a member is not what its checksum says")
        n = min(len(buffer), len(self.held))
        buffer[:n] = self.held[:n]
        self.held = self.held[n:]
        return n


def _member_blocks(row: dict, encoding: str) -> Iterator[str]:
    with opened(row["path"]) as raw:
        if row["method"] in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) and not row["flags"] & 1:
            member = _Member(raw, *[row[c] for c in ("offset", "packed", "size", "checksum", "method")])
            yield from _line_blocks(io.BufferedReader(member, READ_BYTES), encoding)
            return
        with zipfile.ZipFile(raw) as archive:  # of another kind: by the directory once more
            info = next(m for m in archive.infolist() if m.header_offset == row["offset"])
            with archive.open(info) as stream:
                yield from _line_blocks(stream, encoding)


def _whole_blocks(files: DataFrame, encoding: str) -> DataFrame:
    """Blocks of archives whose content Spark reads."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                try:
                    with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                        for info in archive.infolist():
                            if not info.is_dir():
                                with archive.open(info) as stream:
                                    for block in _line_blocks(stream, encoding):
                                        yield _rows(BLOCK_SCHEMA, [(path.as_py(), info.filename, block, None)])
                except Exception as error:  # noqa: BLE001 - told per archive
                    yield _rows(BLOCK_SCHEMA, [(path.as_py(), None, None, _told(error))])

    # The scan takes the condition on the length, so it does not touch the content of larger files.
    limit = int(files.sparkSession.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))
    small = files.filter(F.col("length") <= limit).select("path", "content")
    none = F.lit(None).cast("string")
    large = files.filter(F.col("length") > limit).select(
        "path", none.alias("member"), none.alias("block"),
        F.concat(F.lit("larger than the limit of a scan: "), F.col("length").cast("string")).alias("error"),
    )
    return small.mapInArrow(unpacked, BLOCK_SCHEMA).union(large)


def archive_blocks(files: DataFrame, encoding: str = ENCODING) -> DataFrame:
    """Blocks of lines of every member of the archives in `files`, a scan by `binary_files`.

    There are as many tasks as members. Rows of an archive with an error may stand beside blocks of its other members.
    """
    if not tasks_can_open(files.inputFiles()):
        return _whole_blocks(files, encoding)
    spark = files.sparkSession
    path = fresh_path(spark, "members")
    archive_members(files).write.parquet(path)
    members = spark.read.schema(MEMBER_SCHEMA).parquet(path)
    units = members.filter("error is null")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    for block in _member_blocks(row, encoding):
                        yield _rows(BLOCK_SCHEMA, [(row["path"], row["member"], block, None)])
                except Exception as error:  # noqa: BLE001 - told per archive
                    yield _rows(BLOCK_SCHEMA, [(row["path"], row["member"], None, _told(error))])

    # Ranges of one member each.
    dealt = units.repartitionByRange(max(1, units.count()), "path", "offset")
    broken = members.filter("error is not null").select("path", "member", F.lit(None).cast("string").alias("block"), "error")
    return dealt.mapInArrow(unpacked, BLOCK_SCHEMA).union(broken)


def lines_of(blocks: DataFrame) -> DataFrame:
    """(path, member, line) of the non-empty lines of blocks."""
    lines = blocks.filter(F.col("block").isNotNull()).select(
        "path", "member", F.explode(F.split("block", "\n")).alias("line")
    )
    return lines.filter("line <> ''")


def archive_lines(files: DataFrame, encoding: str = ENCODING) -> DataFrame:
    """Lines of all archives in `files`; the first archive that cannot be read fails the query."""
    blocks = archive_blocks(files, encoding)
    checked = blocks.withColumn(
        "block", F.when(F.col("error").isNull(), F.col("block")).otherwise(
            F.raise_error(F.concat_ws(": ", "path", "error")).cast("string")
        ),
    )
    return lines_of(checked)


def is_archive():
    return F.lower("table_name").endswith(".zip")
