"""Side outputs that are exact under replay: rejects, planned downloads, pages without an address.

A foreachBatch call, or a load that is started again, may run more than once. What one attempt writes lies in the
folder of its (part, batch); the next attempt replaces just that folder (dynamic partition overwrite, committed as one
job), so a reader sees each batch once, whichever attempt was the last.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PART, BATCH = "_part", "_batch"


def write_once(rows: DataFrame, path: str, part: str, batch: str) -> int:
    """Put ``rows`` in place of all that ``(part, batch)`` held under ``path``; returns their number.

    An attempt without rows leaves the folder as it is: attempts of one batch give the same rows."""
    n = Observation("written")
    out = rows.observe(n, F.count(F.lit(1)).alias("n")).withColumn(PART, F.lit(part)).withColumn(BATCH, F.lit(batch))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(path)
    return n.get["n"]


def read_written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows under ``path`` with ``schema`` and the columns ``_part`` and ``_batch`` behind it."""
    return spark.read.schema(f"{schema}, {PART} string, {BATCH} string").parquet(path)


def content_id(count: int, checksum: int | None) -> str:
    """A batch's name where its caller gives none: equal rows, equal name (see ``checksum_of``)."""
    return hashlib.sha256(f"{count}:{checksum or 0}".encode()).hexdigest()[:24]


def checksum_of(columns: list[Column]) -> Column:
    """An aggregate over rows that is the same in any order; for ``Observation``s of a write."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def stream_batch(spark: SparkSession, epoch_id: int) -> str:
    """The name of a micro-batch: its query's id, which the checkpoint keeps over restarts, and its number."""
    job = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if job is None:
        raise RuntimeError("stream_batch is called within foreachBatch only")
    return f"{job}-{epoch_id}"
