"""Report files -> a *lines frame*.

A lines frame is the one input contract of the parser:

    source_file string   full path of the file (percent-decoded once, i.e. the on-disk text)
    file_name   string   last path segment of ``source_file``
    block_start bigint   byte offset of the split the line came from
    line_id     bigint   increasing within a split
    value       string   the raw line

``(source_file, block_start, line_id)`` reproduces file order even though splits of one file land in
different partitions: ids are taken on the scan itself, before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.functions.names import base_name, percent_decode
from voltline.session import glob_escaped

LINES_COLUMNS = ["source_file", "file_name", "block_start", "line_id", "value"]


def raw_path(column: str, encoded: bool = False) -> Column:
    """The on-disk path text. The binary source's ``path`` is raw; ``_metadata.file_path`` is percent-encoded once."""
    path = F.regexp_replace(F.col(column), r"^file:(//)?", "")
    return percent_decode(path) if encoded else path


def list_files(spark: SparkSession, path: str, glob: str, recursive: bool = True) -> DataFrame:
    """Distributed listing: (source_file, file_name, size, modified). File contents are not read."""
    df = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    src = raw_path("path")
    return df.select(
        src.alias("source_file"),
        base_name(src).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def read_report_lines(
    spark: SparkSession,
    path: str | list[str],
    glob: str = "*.[cC][sS][vV]",
    recursive: bool = True,
    file_filter: Column | None = None,
) -> DataFrame:
    """Read report files as a lines frame; a list of paths is taken literally, a single path may be a glob.

    ``file_filter`` is an expression over ``file_name`` (e.g. a route or period test); it is applied
    to the file metadata before ids are attached, so Spark prunes whole files at listing time.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob)
    raw = reader.text([glob_escaped(p) for p in path] if isinstance(path, list) else [path])
    src = raw_path("_metadata.file_path", encoded=True)
    df = raw.select(
        src.alias("source_file"),
        base_name(src).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value"),
    )
    if file_filter is not None:
        df = df.filter(file_filter)
    # ids are attached after the file filter and before anything that could shuffle
    return df.select("source_file", "file_name", "block_start", F.monotonically_increasing_id().alias("line_id"), "value")
