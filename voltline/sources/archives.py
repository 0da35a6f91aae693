"""Zip archives -> member rows -> lines frames.

Archives are read with the ``binaryFile`` source (one row per archive) and expanded on the
executors by one ``mapInPandas``: nested zips are opened in memory, to any depth, and members are
handed on one by one. A damaged archive or member becomes a row with ``error`` set instead of failing
the job or looping (V4). Members keep their full nesting path, so identical member names in
different archives never overwrite each other.
"""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.session import ship_package

from voltline.functions.names import base_name
from voltline.functions.text import drop_invalid_utf8
from voltline.sources.lines import list_files, raw_path

MEMBER_SCHEMA = "archive string, member string, depth int, content binary, error string"
ZIP_GLOB = "*.[zZ][iI][pP]"
#: Bytes of members that a task holds before it hands them on.
_EXPAND_BYTES = 16 << 20


def read_archives(spark: SparkSession, path: str, glob: str = ZIP_GLOB, recursive: bool = True, file_filter: Column | None = None) -> DataFrame:
    """(archive, file_name, content) per zip file under ``path``.

    ``file_filter`` is an expression over ``file_name``. Names are taken from the file metadata, so files that it
    refuses are pruned when the folder is listed and their content is never read.
    """
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", glob)
        .load(path)
    )
    src = raw_path("_metadata.file_path", encoded=True)
    out = df.select(src.alias("archive"), base_name(src).alias("file_name"), "content")
    return out if file_filter is None else out.filter(file_filter)


def archive_paths(spark: SparkSession, path: str, glob: str = ZIP_GLOB, recursive: bool = True, file_filter: Column | None = None) -> DataFrame:
    """S2 without content: (archive, file_name, size, modified) per zip file under ``path``, for ``members.member_chunks``."""
    out = list_files(spark, path, glob, recursive).withColumnRenamed("source_file", "archive")
    return out if file_filter is None else out.filter(file_filter)


def _members(archive: str, data: bytes):
    """Non-zip members of an archive and of the zips inside it; the open zips stand on a stack, so any depth works."""
    try:
        stack = [_opened(data, "")]
    except Exception as exc:
        yield (archive, archive, 1, None, f"bad archive: {exc}")
        return
    while stack:
        zf, prefix, infos = stack[-1]
        info = next(infos, None)
        if info is None:
            stack.pop()
            continue
        name = prefix + info.filename
        try:
            payload = zf.read(info)
        except Exception as exc:
            yield (archive, name, len(stack), None, f"bad member: {exc}")
            continue
        if not info.filename.lower().endswith(".zip"):
            yield (archive, name, len(stack), payload, None)
            continue
        try:
            stack.append(_opened(payload, name + "!/"))
        except Exception as exc:
            yield (archive, name, len(stack) + 1, None, f"bad archive: {exc}")


def _opened(data: bytes, prefix: str):
    zf = zipfile.ZipFile(io.BytesIO(data))
    return zf, prefix, iter([i for i in zf.infolist() if not i.is_dir()])


def expand_archives(archives: DataFrame) -> DataFrame:
    """S3 + S4: one row per non-zip member (nested zips expanded): archive, member, depth, content, error."""

    def _expand(batches):
        import pandas as pd

        columns = ["archive", "member", "depth", "content", "error"]
        for pdf in batches:
            for archive, content in zip(pdf["archive"], pdf["content"]):
                rows, size = [], 0
                for row in _members(archive, bytes(content)):
                    rows.append(row)
                    size += len(row[3] or b"")
                    if size > _EXPAND_BYTES:  # members leave the task while the archive is still being read
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    ship_package(archives.sparkSession)
    return archives.select("archive", "content").mapInPandas(_expand, MEMBER_SCHEMA)


def failed_members(members: DataFrame) -> DataFrame:
    """(source_file, file_name, reason) of the archives and members that could not be opened."""
    bad = members.filter(F.col("error").isNotNull())
    return bad.select(F.concat("archive", F.lit("!/"), "member").alias("source_file"), base_name("member").alias("file_name"), F.col("error").alias("reason"))


def member_lines(members: DataFrame, glob_suffix: str | None = ".csv") -> DataFrame:
    """Members -> lines frame (universal newlines, invalid bytes dropped later by the parser).

    ``source_file`` is ``archive!/member``; ``line_id`` is the line's position in the member.
    """
    m = members.filter(F.col("error").isNull())
    if glob_suffix:
        m = m.filter(F.lower("member").endswith(glob_suffix.lower()))
    text = drop_invalid_utf8(F.col("content").cast("string"))
    lines = F.split(F.regexp_replace(text, r"(\r\n|\r|\n)$", ""), r"\r\n|\r|\n")
    return m.select(
        F.concat("archive", F.lit("!/"), "member").alias("source_file"),
        base_name("member").alias("file_name"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.posexplode(lines).alias("line_id", "value"),
    ).withColumn("line_id", F.col("line_id").cast("bigint"))


def write_zip_archives(rows: DataFrame, out_dir: str) -> DataFrame:
    """Write (archive string, inner string, member string, data binary) rows as zip files.

    ``archive`` names the file under ``out_dir``; a non-empty ``inner`` nests the member in a zip of
    that name inside the archive. One task per archive, rows streamed in (archive, inner) order, so
    only one inner zip is held in memory at a time. Returns (archive, members) per written file.
    """
    out = out_dir.rstrip("/")

    def _write(batches):
        import pandas as pd
        from voltline.session import open_filesystem

        filesystem, root = open_filesystem(out)
        filesystem.create_dir(root, recursive=True)
        state = {"name": None, "zip": None, "stream": None, "inner": None, "ibuf": None, "izip": None, "n": 0}

        def close_inner():
            if state["izip"] is not None:
                state["izip"].close()
                state["zip"].writestr(state["inner"], state["ibuf"].getvalue())
                state["izip"], state["ibuf"], state["inner"] = None, None, None

        def close_outer():
            close_inner()
            if state["zip"] is not None:
                state["zip"].close()
                state["stream"].close()
                done = (state["name"], state["n"])
                state["zip"], state["stream"], state["n"] = None, None, 0
                return done
            return None

        for pdf in batches:
            out_rows = []
            for archive, inner, member, data in zip(pdf["archive"], pdf["inner"], pdf["member"], pdf["data"]):
                if archive != state["name"]:
                    done = close_outer()
                    if done:
                        out_rows.append(done)
                    state["name"] = archive
                    state["stream"] = filesystem.open_output_stream(f"{root}/{archive}")
                    state["zip"] = zipfile.ZipFile(state["stream"], "w", zipfile.ZIP_DEFLATED)
                if inner:
                    if inner != state["inner"]:
                        close_inner()
                        state["inner"], state["ibuf"] = inner, io.BytesIO()
                        state["izip"] = zipfile.ZipFile(state["ibuf"], "w", zipfile.ZIP_DEFLATED)
                    state["izip"].writestr(member, bytes(data))
                else:
                    close_inner()
                    state["zip"].writestr(member, bytes(data))
                state["n"] += 1
            if out_rows:
                yield pd.DataFrame(out_rows, columns=["archive", "members"])
        done = close_outer()
        if done:
            yield pd.DataFrame([done], columns=["archive", "members"])

    ship_package(rows.sparkSession)
    # dealt by the name's hash, see ``render.write_report_files``: one task writes an archive, whatever join rows come from
    ordered = rows.repartition(F.xxhash64("archive")).sortWithinPartitions("archive", "inner", "member")
    return ordered.select("archive", "inner", "member", "data").mapInPandas(_write, "archive string, members long")
