"""Shared helpers of the text operators: table access and block-wise Arrow maps.

Every operator selects the id and text columns by name and returns its own columns beside the id, so further
columns of the input, also ones named like an output, never clash. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.session import ship_package

ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
}
#: Bytes of text that a Python task turns into arrays at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[slice, list[str | None]]]:
    """Slices of a column of texts, of about ``limit`` bytes each, with their texts: only these are Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield slice(start, i), column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes)), column.slice(start).to_pylist()


#: Rows of an Arrow batch of whole texts: with Spark's default of 10,000 a batch of two texts a row takes 100 MB on either side.
BATCH_ROWS = 1_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand Python workers ``BATCH_ROWS`` rows at a time at most; the session's setting comes back after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    if not 0 < int(old) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def settle() -> None:
    """Give memory that Arrow and the C library hold unused back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_texts(df: DataFrame, id_col: str, text_col: str, fn: Callable[[list[str]], dict], fields: dict[str, str], limit: int = BLOCK_BYTES) -> DataFrame:
    """``fn`` over blocks of texts: one output row for each input row, the id in front.

    ``fields`` maps output columns to Spark types (keys of ``ARROW``); ``fn`` returns a sequence for each.
    """
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()
    names = [id_col, *fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch.column(1), limit):
                out = fn(texts)
                cols = [batch.column(0).slice(part.start, part.stop - part.start)]
                cols += [pa.array(out[k], type=ARROW[v]) for k, v in fields.items()]
                yield pa.RecordBatch.from_arrays(cols, names=names)
        settle()

    schema = ", ".join(f"`{k}` {v}" for k, v in [(id_col, id_type), *fields.items()])
    return src.mapInArrow(run, schema)


def keep_texts(df: DataFrame, text_col: str, keep: Callable[[list[str]], Iterable[bool]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text ``keep`` accepts; it is given blocks of texts.

    A null text is judged as the empty one, each of several equal rows by itself; a text of any length is given whole;
    an empty table stays empty."""
    ship_package(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch.column(at)):
                yield batch.slice(part.start, part.stop - part.start).filter(pa.array(keep([t or "" for t in texts]), pa.bool_()))
        settle()

    return df.mapInArrow(run, df.schema)


def rewrite_texts(df: DataFrame, text_col: str, fn: Callable[[str], str]) -> DataFrame:
    """``df`` with ``fn`` of each text in its place; null texts stay null, all rows and other columns as they are."""
    ship_package(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch.column(at)):
                cols = batch.slice(part.start, part.stop - part.start).columns
                cols[at] = pa.array([None if t is None else fn(t) for t in texts], batch.schema.types[at])
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)
        settle()

    return df.mapInArrow(run, df.schema)


def crc_mod(id_col: str, m: int):
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m
