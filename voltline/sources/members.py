"""S3 + S4 for archives of any size: members leave their archive as chunks of lines, none is held whole.

Two maps over paths, no content column. The first reads each archive's central directory (a few bytes at its end)
and bundles consecutive entries of about ``bundle_bytes``; the bundles, rows of a few numbers, are dealt to as many
tasks as their unpacked bytes ask for. The second opens the archive once per bundle and inflates entry after entry in
pieces, emitting lines in chunks of about ``chunk_bytes``. A zip inside a zip is read through its outer stream: its
directory costs one pass, its members, taken in the order they lie in the file, one more. A task holds one piece, one
chunk and the open directories, whatever the members' sizes; one line is the least it must hold.

A damaged archive or member gives a row with ``error``; the lines that it gave before are dropped by ``chunk_lines``.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.functions.names import base_name
from voltline.session import materialize, open_filesystem, ship_package

BUNDLE_SCHEMA = "archive string, first_entry long, entries long, bytes long, error string"
CHUNK_SCHEMA = "archive string, member string, depth int, first_line long, lines array<binary>, error string"
CHUNK_BYTES = 4 << 20
BUNDLE_BYTES = 64 << 20
#: Unpacked bytes that one task is dealt.
TASK_BYTES = 256 << 20
_PIECE = 1 << 20
_NEWLINE = re.compile(rb"\r\n|\r|\n")


def _files(zf: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Entries in the order they lie in the file, so that a stream is read forward only."""
    return sorted((i for i in zf.infolist() if not i.is_dir()), key=lambda i: i.header_offset)


class _Bytes(io.RawIOBase):
    """A random-access file as ``zipfile`` expects it: a seek before the start is an ``OSError``."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0 if whence == io.SEEK_SET else self.file.tell() if whence == io.SEEK_CUR else self.file.size())
        if at < 0:
            raise OSError("seek before the start")
        self.file.seek(at)
        return at

    def readinto(self, buffer) -> int:
        got = self.file.read(len(buffer))
        buffer[: len(got)] = got
        return len(got)

    def close(self) -> None:
        self.file.close()
        super().close()


def _open(path: str) -> io.BufferedReader:
    filesystem, inside = open_filesystem(path)
    return io.BufferedReader(_Bytes(filesystem.open_input_file(inside)), 1 << 16)


def _bundles(archive: str, bundle_bytes: int) -> Iterator[tuple]:
    try:
        with _open(archive) as f, zipfile.ZipFile(f) as zf:
            sizes = [i.file_size for i in _files(zf)]
    except Exception as exc:
        yield (archive, 0, 0, 0, f"bad archive: {exc}")
        return
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= bundle_bytes or i + 1 == len(sizes):
            yield (archive, first, i + 1 - first, total, None)
            first, total = i + 1, 0


def archive_bundles(archives: DataFrame, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """One row per run of consecutive entries of each archive (column ``archive``: its path); a bad archive has ``error``."""
    ship_package(archives.sparkSession)
    names = [c.split()[0] for c in BUNDLE_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = list(_bundles(archive, bundle_bytes))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names=names)

    return archives.select("archive").mapInArrow(run, BUNDLE_SCHEMA)


def line_chunks(stream, chunk_bytes: int) -> Iterator[list[bytes]]:
    """Lines of a binary stream (\\n, \\r\\n or \\r end one; the last needs no end) in lists of about ``chunk_bytes``; an empty one is one empty line."""
    held, size, ahead, empty = [], 0, [], True  # ahead: pieces of a line not ended yet
    while piece := stream.read(_PIECE):
        empty = False
        waits = bool(ahead) and ahead[-1].endswith(b"\r")
        ahead.append(piece)
        if not (waits or b"\n" in piece or b"\r" in piece):
            continue
        text = b"".join(ahead)
        tail = b"\r" if text.endswith(b"\r") else b""  # a line feed may follow
        parts = _NEWLINE.split(text[: len(text) - len(tail)])
        rest = parts.pop() + tail
        ahead = [rest] if rest else []
        for p in parts:
            held.append(p)
            size += len(p) + 1
            if size >= chunk_bytes:
                yield held
                held, size = [], 0
    if ahead or empty:
        held.append(b"".join(ahead).removesuffix(b"\r"))
    if held:
        yield held


def _walk(zf: zipfile.ZipFile, infos: list[zipfile.ZipInfo], prefix: str, depth: int, suffix: str, chunk_bytes: int) -> Iterator[tuple]:
    """(member, depth, first line, lines, error) of the entries and of the zips among them."""
    for info in infos:
        name = prefix + info.filename
        lower = info.filename.lower()
        try:
            if lower.endswith(".zip"):
                try:
                    inner = zipfile.ZipFile(zf.open(info))
                except Exception as exc:
                    yield (name, depth + 1, 0, None, f"bad archive: {exc}")
                    continue
                with inner:
                    yield from _walk(inner, _files(inner), name + "!/", depth + 1, suffix, chunk_bytes)
            elif lower.endswith(suffix):
                first = 0
                with zf.open(info) as stream:
                    for lines in line_chunks(stream, chunk_bytes):
                        yield (name, depth, first, lines, None)
                        first += len(lines)
        except Exception as exc:
            yield (name, depth, 0, None, f"bad member: {exc}")


def member_chunks(archives: DataFrame, suffix: str = ".csv", chunk_bytes: int = CHUNK_BYTES, bundle_bytes: int = BUNDLE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Chunks of lines of every member whose name ends in ``suffix`` (any case), zips inside zips included.

    Columns as in ``CHUNK_SCHEMA``; ``first_line`` is the number of the chunk's first line in its member. The bundles
    are written once; their unpacked bytes set the number of tasks.
    """
    spark = archives.sparkSession
    bundles = materialize(archive_bundles(archives, bundle_bytes), "bundles")
    total, n = bundles.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, min(n, -(-total // task_bytes), 100_000), min(n, spark.sparkContext.defaultParallelism))
    suffix = suffix.lower()
    names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def rows_of(archive: str, first: int, entries: int, error: str | None) -> Iterator[tuple]:
        if error:
            yield (archive, archive, 1, 0, None, error)
            return
        with _open(archive) as f, zipfile.ZipFile(f) as zf:
            for row in _walk(zf, _files(zf)[first : first + entries], "", 1, suffix, chunk_bytes):
                yield (archive, *row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for archive, first, entries, error in zip(*(batch.column(c).to_pylist() for c in ("archive", "first_entry", "entries", "error"))):
                for row in rows_of(archive, first, entries, error):
                    held.append(row)
                    size += sum(map(len, row[4] or ()))
                    if size >= chunk_bytes:
                        yield batch_of(held)
                        held, size = [], 0
            if held:
                yield batch_of(held)

    return bundles.repartition(tasks, "archive", "first_entry").mapInArrow(run, CHUNK_SCHEMA)


def failed_chunks(chunks: DataFrame) -> DataFrame:
    """(source_file, file_name, reason) of the archives and members that could not be read to their end."""
    bad = chunks.filter(F.col("error").isNotNull())
    return bad.select(F.concat("archive", F.lit("!/"), "member").alias("source_file"), base_name("member").alias("file_name"), F.col("error").alias("reason"))


def chunk_lines(chunks: DataFrame) -> DataFrame:
    """Chunks (written once: they are read twice here) -> lines frame; members that failed give none.

    ``source_file`` is ``archive!/member``, ``block_start`` the chunk's first line, ``line_id`` the place in the chunk.
    """
    bad = chunks.filter(F.col("error").isNotNull()).select("archive", "member").distinct()
    good = chunks.filter(F.col("error").isNull()).join(bad, ["archive", "member"], "left_anti")
    return good.select(
        F.concat("archive", F.lit("!/"), "member").alias("source_file"),
        base_name("member").alias("file_name"),
        F.col("first_line").alias("block_start"),
        F.posexplode("lines").alias("line_id", "value"),
    ).select("source_file", "file_name", "block_start", F.col("line_id").cast("bigint").alias("line_id"), F.col("value").cast("string").alias("value"))
