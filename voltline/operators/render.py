"""Render a table as report lines (C / I / D), the inverse of the parser.

Used to derive report-shaped inputs from ordinary tables (round-trip tests, bench, the driver's
checks). The output is a lines frame (see ``voltline.sources.lines``); ``write_report_files`` puts
it on disk, one file per ``file_name``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltline.session import ship_package
from pyspark.sql import types as T

_COMMENT_ID = -2
_HEADER_ID = -1
_TRAILER_ID = (1 << 62)


def render_field(c: Column, dtype: T.DataType) -> Column:
    """One value as report text: NULL -> empty, timestamps as yyyy/MM/dd HH:mm:ss[.ffffff], text quoted when needed."""
    if isinstance(dtype, T.TimestampNTZType):
        # zone-free: the string cast of a TIMESTAMP_NTZ never consults the session time zone
        plain = c.cast("string")
        text = F.when(F.year(c).between(0, 9999), F.replace(plain, F.lit("-"), F.lit("/"))).otherwise(plain)
    elif isinstance(dtype, T.TimestampType):
        base = F.date_format(c, "yyyy/MM/dd HH:mm:ss")
        frac = F.date_format(c, "SSSSSS")
        text = F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
    elif isinstance(dtype, T.DateType):
        text = F.date_format(c, "yyyy/MM/dd")
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif isinstance(dtype, T.StringType):
        needs_quotes = c.rlike(r'[,"\r\n]|^\s|\s$')
        text = F.when(needs_quotes, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def render_report_lines(
    df: DataFrame,
    file_name: Column,
    order: Column,
    columns: Sequence[str] | None = None,
    report: str = "REPORT",
    sub_report: str = "DATA",
    version: int = 1,
    directory: str = "inbox",
) -> DataFrame:
    """Lines frame: per file one comment line, one header line, one D line per row, one trailer.

    ``order`` must be a non-negative BIGINT that orders rows inside a file (it becomes ``line_id``).
    """
    cols = list(columns) if columns is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    prefix = f"{report},{sub_report},{version}"
    data = df.select(
        file_name.alias("file_name"),
        order.cast("bigint").alias("line_id"),
        F.concat_ws(",", F.lit("D," + prefix), *[render_field(F.col(c), types[c]) for c in cols]).alias("value"),
    )
    header_text = "I," + prefix + "," + ",".join(cols)
    files = data.select("file_name").distinct()
    meta = files.select(
        "file_name",
        F.explode(
            F.array(
                F.struct(F.lit(_COMMENT_ID).cast("bigint").alias("line_id"), F.lit(f"C,{report} rendered").alias("value")),
                F.struct(F.lit(_HEADER_ID).cast("bigint").alias("line_id"), F.lit(header_text).alias("value")),
                F.struct(F.lit(_TRAILER_ID).cast("bigint").alias("line_id"), F.lit("C,END OF REPORT").alias("value")),
            )
        ).alias("m"),
    ).select("file_name", "m.line_id", "m.value")
    lines = data.unionByName(meta)
    return lines.select(
        F.concat(F.lit(directory.rstrip("/") + "/"), F.col("file_name")).alias("source_file"),
        "file_name",
        F.lit(0).cast("bigint").alias("block_start"),
        "line_id",
        "value",
    )


def write_report_files(lines: DataFrame, out_dir: str, newline: str = "\n") -> DataFrame:
    """Write a lines frame as text files named ``out_dir/<file_name>`` and return (file_name, lines) per file.

    Each file is written by one task that streams its lines in order, so memory stays bounded
    whatever the file size; different files are written in parallel.
    """
    out = out_dir.rstrip("/")

    def _write(batches):
        import pandas as pd
        from voltline.session import open_filesystem

        filesystem, root = open_filesystem(out)
        filesystem.create_dir(root, recursive=True)
        current, stream, count = None, None, 0
        for pdf in batches:
            for name, value in zip(pdf["file_name"], pdf["value"]):
                if name != current:
                    if stream is not None:
                        stream.close()
                        yield pd.DataFrame({"file_name": [current], "lines": [count]})
                    current, count = name, 0
                    stream = filesystem.open_output_stream(f"{root}/{name}")
                stream.write((value + newline).encode("utf-8"))
                count += 1
        if stream is not None:
            stream.close()
            yield pd.DataFrame({"file_name": [current], "lines": [count]})

    ship_package(lines.sparkSession)
    # dealt by the name's hash: where lines come from a join on the name, Spark takes a repartition by the name itself
    # for done and may then split the join's partitions, so that two tasks would write one file
    ordered = lines.repartition(F.xxhash64("file_name")).sortWithinPartitions("file_name", "block_start", "line_id")
    return ordered.select("file_name", "value").mapInPandas(_write, "file_name string, lines long")
