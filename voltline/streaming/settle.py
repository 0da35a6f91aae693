"""K4: files of loaded micro-batches move out of the inbox, once their batch is committed.

Each batch of a stream load notes its files when all its tables and the ledger are written. A batch starts only after the
one before it is committed, so at its start the files of all earlier ones may go: no restart reads them again. The last
batch of a query that has ended is settled by ``settle_files``. Reports and archives go alike; a file lies under its
batch's number in the archive, so one delivered again never overwrites an older one. Moves run in tasks, a batch of
names each, and a move that was done before is no error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.operators.sinks import BATCH, PART, read_written, write_once
from voltline.session import open_filesystem, path_exists, ship_package

NOTES = "_loaded_files"
_SCHEMA = "path string"
#: Files that one task moves.
FILES_PER_TASK = 1_000


def note_files(warehouse: str, files: DataFrame, job: str, epoch_id: int) -> int:
    """Note the files (``path``) of a batch that is loaded; noted again, they are the same."""
    return write_once(files.select("path").distinct(), f"{warehouse.rstrip('/')}/{NOTES}", job, str(epoch_id))


def noted_files(spark: SparkSession, warehouse: str) -> DataFrame:
    """(path, job, epoch) of all files noted."""
    path = f"{warehouse.rstrip('/')}/{NOTES}"
    rows = read_written(spark, path, _SCHEMA) if path_exists(path, spark) else spark.createDataFrame([], f"{_SCHEMA}, {PART} string, {BATCH} string")
    return rows.select("path", F.col(PART).alias("job"), F.col(BATCH).cast("bigint").alias("epoch"))


def settle_files(spark: SparkSession, warehouse: str, inbox: str, archive_dir: str, job: str, before: int | None = None) -> int:
    """Move the noted files of the job's batches before ``before`` (all, for a query that has ended) from ``inbox`` to ``archive_dir``.

    Returns how many were there to move."""
    rows = noted_files(spark, warehouse).filter(F.col("job") == job)
    if before is not None:
        rows = rows.filter(F.col("epoch") < before)
    n = rows.count()
    if not n:
        return 0
    ship_package(spark)
    # noted paths are the on-disk text (``sources.lines.raw_path``)
    root, target = re.sub(r"^file:(//)?", "", inbox.rstrip("/")), archive_dir.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = 0
            for path, epoch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = path[len(root) :] if path.startswith(root + "/") else "/" + path.rsplit("/", 1)[-1]
                source, here = open_filesystem(path)
                there = open_filesystem(f"{target}/{epoch}{name}")[1]
                if source.get_file_info(here).is_file:
                    source.create_dir(there.rsplit("/", 1)[0], recursive=True)
                    source.move(here, there)
                    moved += 1
            yield pa.RecordBatch.from_arrays([pa.array([moved], pa.int64())], names=["moved"])

    dealt = rows.select("path", "epoch").repartition(-(-n // FILES_PER_TASK))
    return dealt.mapInArrow(run, "moved long").agg(F.coalesce(F.sum("moved"), F.lit(0))).first()[0]
