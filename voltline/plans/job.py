"""G1: one call that plans what to fetch, expands the archives that are there and loads them.

Fetching itself is left to the caller: the manifest is what a downloader takes, the folder what it fills.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.operators.ledger import read_ledger
from voltline.operators.load import REPORT_SCHEMA, write_rejects
from voltline.operators.sinks import checksum_of, content_id, read_written, write_once
from voltline.plans.acquire import extract_window, plan_downloads
from voltline.plans.load import LoadOptions, load_lines, plan_candidates
from voltline.session import materialize, path_exists
from voltline.sources.archives import archive_paths
from voltline.sources.members import CHUNK_BYTES, chunk_lines, failed_chunks, member_chunks


#: Archives that loads have taken, sound and damaged ones, under the warehouse.
TAKEN = "_taken_archives"
TAKEN_SCHEMA = "archive string, size bigint, modified timestamp"


@dataclass
class JobResult:
    manifest: DataFrame  # links to fetch
    status: DataFrame  # one row per member file that was asked for
    report: DataFrame  # one row per table


def load_archives(spark: SparkSession, folder: str, warehouse: str, ledger_path: str, opts: LoadOptions | None = None,
                  chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """G6 + G7: the zip archives under ``folder`` inside the period window, but for those loaded as they are now.

    Archives are told apart by path, size and time; nothing of a skipped one is read. Members are streamed in chunks,
    routed and tested by their own names. Returns (file status, per-table report); damaged archives are rejects, once.
    """
    opts = opts or LoadOptions()
    ledger = read_ledger(spark, ledger_path)
    found = archive_paths(spark, folder, file_filter=extract_window(opts.start_year, opts.end_year, opts.months))
    notes = f"{warehouse.rstrip('/')}/{TAKEN}"
    done = read_written(spark, notes, TAKEN_SCHEMA) if path_exists(notes, spark) else spark.createDataFrame([], TAKEN_SCHEMA)
    todo, n = materialize(found.join(done.select("archive", "size", "modified"), ["archive", "size", "modified"], "left_anti"), "archives", with_count=True)
    if n == 0:
        return spark.createDataFrame([], "source_file string, file_name string, status string"), spark.createDataFrame([], REPORT_SCHEMA)
    batch = content_id(*todo.agg(F.count(F.lit(1)), checksum_of([F.col(c) for c in ("archive", "size", "modified")])).first())
    chunks = materialize(member_chunks(todo, chunk_bytes=chunk_bytes), "member-chunks")
    write_rejects(warehouse, failed_chunks(chunks), "archives", batch)
    lines = chunk_lines(chunks)
    files = lines.select("source_file", "file_name").distinct().withColumn("archive", F.substring_index("source_file", "!/", 1))
    routes = materialize(plan_candidates(files.join(todo.select("archive", "size", "modified"), "archive").drop("archive"), ledger, opts), "member-routes")
    status, reports = load_lines(spark, lines.join(routes.select("source_file"), "source_file", "left_semi"), routes, warehouse, ledger_path, opts, batch=batch)
    write_once(todo.select("archive", "size", "modified"), notes, "archives", batch)  # last: what is noted is loaded
    return status, spark.createDataFrame([r.as_row() for r in reports], REPORT_SCHEMA)


def run_job(spark: SparkSession, source: str, pages: DataFrame, folder: str, warehouse: str, ledger_path: str,
            opts: LoadOptions | None = None, **plan) -> JobResult:
    """G1: ``plan_downloads`` over the fetched listing pages, then ``load_archives`` over the folder of archives.

    ``plan`` goes to ``plan_downloads`` (tables, feeds, base_url, ...); the window is that of ``opts``. Archives in the
    folder count as fetched. The manifest is planned on the ledger as it was before the load.
    """
    opts = opts or LoadOptions()
    plan = {"start_year": opts.start_year, "end_year": opts.end_year, "months": list(opts.months), **plan}
    here = archive_paths(spark, folder).select("file_name")
    manifest = materialize(plan_downloads(spark, source, pages, read_ledger(spark, ledger_path), here, **plan), "manifest")
    return JobResult(manifest, *load_archives(spark, folder, warehouse, ledger_path, opts))
