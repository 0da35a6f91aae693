"""The current-feed poll as a Structured Streaming query.

Fetched listing pages (one HTML file per fetch, dropped in a folder by whatever does the HTTP) are
read as a stream; every micro-batch runs the download planner and adds the new manifest rows (links
not planned before) to a Parquet manifest, under its own name: a batch that runs again replaces its
rows. The trigger interval replaces the poll loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltline import catalog
from voltline.operators.ledger import read_ledger
from voltline.operators.sinks import BATCH, read_written, stream_batch, write_once
from voltline.plans.acquire import plan_downloads
from voltline.functions.names import base_name
from voltline.session import materialize, path_exists
from voltline.sources.lines import raw_path

MANIFEST_KEY = "url"
MANIFEST_SCHEMA = "url string, file_name string"


def start_manifest_stream(
    spark: SparkSession,
    pages_dir: str,
    page_urls: DataFrame,
    manifest_path: str,
    checkpoint: str,
    ledger_path: str | None = None,
    source: str = "current",
    feeds: Sequence[dict] | None = None,
    root_url: str | None = None,
    tables: Sequence[str] = catalog.DEFAULT_WANTED_TABLES,
    local_files: DataFrame | None = None,
    start_year: int = catalog.DEFAULT_START_YEAR,
    end_year: int = catalog.DEFAULT_END_YEAR,
    months: Sequence[int] = catalog.DEFAULT_MONTHS,
    available_now: bool = True,
    interval_seconds: int = catalog.CURRENT_FEED_POLL_SECONDS,
) -> StreamingQuery:
    """Plan downloads from each batch of fetched pages.

    ``page_urls`` maps a page file name (``file_name``, as on disk) to the URL it was fetched from (``url``). A page
    without one is listed in ``<manifest_path>_unmapped``. Links in ``local_files`` (``file_name``) are not planned,
    nor manifest rows already present (by url); the window holds for the archive source.
    """
    pages = (
        spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.htm*")
        .load(pages_dir)
        .select(base_name(raw_path("_metadata.file_path", encoded=True)).alias("file_name"), F.col("value").alias("html"))
    )

    def _plan(batch: DataFrame, epoch_id: int) -> None:
        found = materialize(batch.join(page_urls.select("file_name", "url"), "file_name", "left"), "fetched-pages")
        name = stream_batch(spark, epoch_id)
        write_once(found.filter(F.col("url").isNull()).select("file_name"), f"{manifest_path}_unmapped", source, name)
        fetched = found.filter(F.col("url").isNotNull()).select(F.col("file_name").alias("page_id"), "url", "html")
        local = local_files if local_files is not None else spark.createDataFrame([], "file_name string")
        manifest = plan_downloads(spark, source, fetched, read_ledger(spark, ledger_path), local, tables=tables, feeds=feeds,
                                  root_url=root_url, start_year=start_year, end_year=end_year, months=months)
        manifest = manifest.select("url", "file_name").distinct()
        if path_exists(manifest_path, spark):
            # rows of an earlier attempt of this batch are planned again and replaced
            before = read_written(spark, manifest_path, MANIFEST_SCHEMA).filter(F.col(BATCH) != name)
            manifest = manifest.join(before.select(MANIFEST_KEY), MANIFEST_KEY, "left_anti")
        write_once(materialize(manifest, "manifest"), manifest_path, source, name)

    writer = pages.writeStream.foreachBatch(_plan).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{interval_seconds} seconds")
    return writer.start()
