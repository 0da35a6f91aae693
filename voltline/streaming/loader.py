"""T1 + T3 + T4: the inbox load as a Structured Streaming query.

The file source replaces re-listing the inbox on a timer: its checkpoint remembers which files were
taken, and ``foreachBatch`` runs the same batch load as ``plans.load`` on each micro-batch. The
cross-batch dedupe state is the target table itself (J1) plus the ledger, so the stream keeps no
unbounded ``dropDuplicates`` state. A replayed micro-batch is a no-op: keyed tables drop existing
keys, key-less tables drop files already present by the ``_source_file`` lineage column (V10), and its
rejects replace those of the attempt before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltline import catalog
from voltline.functions.names import base_name
from voltline.operators.ledger import read_ledger
from voltline.operators.load import write_rejects
from voltline.operators.sinks import stream_batch
from voltline.plans.load import LoadOptions, load_lines, plan_candidates
from voltline.session import materialize
from voltline.sources.lines import raw_path
from voltline.sources.members import chunk_lines, failed_chunks, member_chunks
from voltline.streaming.settle import note_files, settle_files


def _batch_lines(batch: DataFrame) -> DataFrame:
    """Lines frame of one micro-batch of the text source (ids taken on the batch scan)."""
    src = raw_path("_file_path", encoded=True)
    return batch.select(
        src.alias("source_file"),
        base_name(src).alias("file_name"),
        F.col("_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        "value",
    )


def start_stream_load(
    spark: SparkSession,
    inbox: str,
    warehouse: str,
    ledger_path: str,
    checkpoint: str,
    opts: LoadOptions | None = None,
    archives: bool = False,
    available_now: bool = True,
    interval_seconds: int = catalog.LOADER_POLL_SECONDS,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Start the continuous loader. ``archives=True`` takes zip files (T3) instead of report files.

    ``archive_dir`` (K4) takes the source files of batches that are loaded and committed: each batch moves those of the
    batches before it, and ``settle.settle_files`` those of the last one when the query has ended.
    """
    opts = opts or LoadOptions()
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archives:
        stream = (
            reader.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", "*.[zZ][iI][pP]").load(inbox).select("path")
        )
    else:
        stream = reader.format("text").option("pathGlobFilter", "*.[cC][sS][vV]").load(inbox).select(
            "value",
            F.col("_metadata.file_path").alias("_file_path"),
            F.col("_metadata.file_block_start").alias("_block_start"),
        )

    def _load(batch: DataFrame, epoch_id: int) -> None:
        name = stream_batch(spark, epoch_id)
        job = name.rsplit("-", 1)[0]
        if archive_dir and epoch_id:
            settle_files(spark, warehouse, inbox, archive_dir, job, before=epoch_id)
        if archives:
            # paths only: the content is read member by member, in chunks
            chunks = materialize(member_chunks(batch.select(raw_path("path").alias("archive"))), "member-chunks")
            write_rejects(warehouse, failed_chunks(chunks), "archives", name)
            lines = chunk_lines(chunks)
        else:
            lines = materialize(_batch_lines(batch), "batch-lines")  # the files are read once
        files = lines.select("source_file", "file_name").distinct()
        routes, n_files = materialize(plan_candidates(files, read_ledger(spark, ledger_path), opts), "stream-routes", with_count=True)
        if n_files == 0:
            return
        keep = routes.select("source_file")
        # one row per file of the micro-batch: broadcast while that list is small, shuffle beyond
        lines = lines.join(F.broadcast(keep) if n_files <= 200_000 else keep, "source_file", "left_semi")
        load_lines(spark, lines, routes, warehouse, ledger_path, opts, batch=name)
        if archive_dir:  # files of no candidate stay where they are
            note_files(warehouse, routes.select(F.substring_index("source_file", "!/", 1).alias("path")), job, epoch_id)

    writer = stream.writeStream.foreachBatch(_load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()
