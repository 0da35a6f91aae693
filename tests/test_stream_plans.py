"""T1/T3 streaming equals batch, replay is a no-op; G2-G6 planning."""

import io
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from voltline.operators.ledger import read_ledger
from voltline.operators.render import write_report_files
from voltline.plans.acquire import check_source, extract_plan, feeds_frame, plan_downloads
from voltline.plans.load import LoadOptions, load_inbox
from voltline.sources.archives import read_archives, write_zip_archives
from voltline.streaming.loader import start_stream_load

HEAD = "I,TRADING,PRICE,2,SETTLEMENTDATE,RUNNO,REGIONID,PERIODID,RRP\n"


def _report(rows):
    return HEAD + "".join(f'D,TRADING,PRICE,2,"2026/01/01 00:{m:02d}:00",1,R1,{m},{m}.5\n' for m in rows)


def test_stream_equals_batch_and_replay(spark):
    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/inbox")
    with open(f"{d}/inbox/PUBLIC_DVD_TRADINGPRICE_202601010000.CSV", "w") as f:
        f.write(_report([1, 2, 2, 3]))
    opts = LoadOptions()
    q = start_stream_load(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger", f"{d}/ckpt", opts)
    q.awaitTermination()
    # second drop: a zip holding a nested zip with a new file and an overlapping key
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("PUBLIC_DVD_TRADINGPRICE_202601020000.CSV", _report([3, 4]))
    os.makedirs(f"{d}/zips")
    with zipfile.ZipFile(f"{d}/zips/PUBLIC_ARCHIVE#TRADINGPRICE#FILE01#202601020000.zip", "w") as z:
        z.writestr("inner.zip", inner.getvalue())
    q = start_stream_load(spark, f"{d}/zips", f"{d}/wh", f"{d}/ledger", f"{d}/ckpt-zip", opts, archives=True)
    q.awaitTermination()
    streamed = sorted(r["PERIODID"] for r in spark.read.parquet(f"{d}/wh/TRADINGPRICE").collect())
    assert streamed == [1, 2, 3, 4]
    # a re-run of the batch job over the same inbox changes nothing (ledger + keys)
    _, rep = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger", opts)
    assert rep.count() == 0
    assert spark.read.parquet(f"{d}/wh/TRADINGPRICE").count() == 4
    # the batch job on a fresh warehouse gives the same table as the stream for the first drop
    _, rep = load_inbox(spark, f"{d}/inbox", f"{d}/wh2", f"{d}/ledger2", opts)
    assert sorted(r["PERIODID"] for r in spark.read.parquet(f"{d}/wh2/TRADINGPRICE").collect()) == [1, 2, 3]


def test_source_dispatch_and_fallback_feed(spark):
    assert check_source(" MMSDM ") == "mmsdm"
    with pytest.raises(ValueError):
        check_source("ftp")
    fr = feeds_frame(spark, None, "https://h.example/Current/").collect()
    assert fr[0]["name"] == "root" and fr[0]["include_patterns"] == []
    assert feeds_frame(spark, None, None).count() == 0


def test_plan_downloads_archive_and_current(spark):
    html = ('<a href="PUBLIC_DISPATCHIS_202601011200.zip">a</a><a href="PUBLIC_TRADINGIS_202601011200.zip">b</a>'
            '<a href="PUBLIC_DISPATCHIS_202512011200.zip">c</a><a href="PUBLIC_DISPATCHIS_LOCAL_202601.zip">d</a>')
    pages = spark.createDataFrame([(1, "https://h.example/Dispatch/", html)], "page_id long, url string, html string")
    feeds = [{"name": "dispatch", "url": "https://h.example/Dispatch/", "tables": ["DISPATCHPRICE"], "include_patterns": ["dispatch"]}]
    local = spark.createDataFrame([("PUBLIC_DISPATCHIS_LOCAL_202601.zip",)], "file_name string")
    empty = read_ledger(spark, None)
    got = plan_downloads(spark, "archive", pages, empty, local, feeds=feeds, start_year=2026, end_year=2026, months=[1])
    assert [r["file_name"] for r in got.collect()] == ["PUBLIC_DISPATCHIS_202601011200.ZIP"]
    ledger = spark.createDataFrame([("dispatchprice", 2026, 1, "x", 1, None, None, None)], empty.schema)
    got = plan_downloads(spark, "archive", pages, ledger, local, feeds=feeds, start_year=2026, end_year=2026, months=[1])
    assert got.count() == 0  # every table of the feed is loaded for that month
    cur = plan_downloads(spark, "current", pages, empty, local, feeds=feeds)
    assert sorted(r["file_name"] for r in cur.collect()) == ["PUBLIC_DISPATCHIS_202512011200.ZIP", "PUBLIC_DISPATCHIS_202601011200.ZIP"]


def test_historical_plan_reads_wanted_months_and_asks_for_the_pages_month(spark):
    from voltline.plans.acquire import month_pages

    base = "https://h.example/"
    page = lambda m: f"{base}2026/MMSDM_2026_{m:02d}/MMSDM_Historical_Data_SQLLoader/DATA/"
    names = ["PUBLIC_DVD_DISPATCHPRICE_202602010000.zip", "PUBLIC_ARCHIVE%23TRADINGPRICE%23LATEST.zip"]
    html = "".join(f'<a href="{n}">x</a>' for n in names)
    pages = spark.createDataFrame([(m, page(m), html) for m in (1, 2, 3, 4)], "page_id long, url string, html string")
    schema = read_ledger(spark, None).schema
    ledger = spark.createDataFrame([(t, 2026, m, f"{t}{m}", 1, None, None, None) for t, m in (("dispatchprice", 1), ("tradingprice", 1), ("dispatchprice", 2))], schema)
    local = spark.createDataFrame([("PUBLIC_DVD_DISPATCHPRICE_202603010000.zip",)], "file_name string")
    wanted = ("DISPATCHPRICE", "TRADINGPRICE")
    args = dict(start_year=2025, end_year=2030, months=[1, 2, 3], current_year=2026)
    grid = {(r["year"], r["month"]) for r in month_pages(spark, wanted, ledger, local, base, **args).collect()}
    assert grid == {(2025, 1), (2025, 2), (2025, 3), (2026, 2), (2026, 3)}  # 2026/1 is complete, later years are to come
    got = plan_downloads(spark, "mmsdm", pages, ledger, local, tables=wanted, base_url=base, **args).collect()
    # page 2: its price file is loaded by the page's month; page 3: nothing is
    assert sorted((r["page_id"], r["table_name"]) for r in got) == [(2, "tradingprice"), (3, "dispatchprice"), (3, "tradingprice")]


def test_extract_plan_period_filter(spark):
    d = tempfile.mkdtemp(prefix="run-")
    for name in ("PUBLIC_DVD_X_202601010000.zip", "PUBLIC_DVD_X_202501010000.zip", "PUBLIC_DVD_X_LATEST.zip"):
        with zipfile.ZipFile(f"{d}/{name}", "w") as z:
            z.writestr(name.replace(".zip", ".CSV"), "I,A,B,1,x\nD,A,B,1,1\n")
    got = sorted(r["member"] for r in extract_plan(read_archives(spark, d), 2026, 2026, [1]).collect())
    assert got == ["PUBLIC_DVD_X_202601010000.CSV", "PUBLIC_DVD_X_LATEST.CSV"]


def test_manifest_stream_and_list_tables(spark):
    from voltline.plans.sql import list_tables, table_counts, warehouse_tables
    from voltline.streaming.planner import start_manifest_stream

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/pages")
    with open(f"{d}/pages/p1.html", "w") as f:
        f.write('<a href="PUBLIC_DISPATCHIS_202601011200.zip">a</a><!-- <a href="OLD.zip"> -->')
    urls = spark.createDataFrame([("p1.html", "https://h.example/Current/"), ("p2.html", "https://h.example/Current/")],
                                 "file_name string, url string")
    q = start_manifest_stream(spark, f"{d}/pages", urls, f"{d}/manifest", f"{d}/ckpt", root_url="https://h.example/Current/")
    q.awaitTermination()
    with open(f"{d}/pages/p2.html", "w") as f:  # next poll: one old link, one new
        f.write('<a href="PUBLIC_DISPATCHIS_202601011200.zip">a</a><a href="PUBLIC_DISPATCHIS_202601011205.zip">b</a>')
    q = start_manifest_stream(spark, f"{d}/pages", urls, f"{d}/manifest", f"{d}/ckpt", root_url="https://h.example/Current/")
    q.awaitTermination()
    m = spark.read.parquet(f"{d}/manifest").collect()
    assert sorted(r["url"] for r in m) == ["https://h.example/Current/PUBLIC_DISPATCHIS_202601011200.zip",
                                           "https://h.example/Current/PUBLIC_DISPATCHIS_202601011205.zip"]
    # Q2 over a warehouse folder
    spark.range(3).write.parquet(f"{d}/wh/T1")
    spark.range(5).write.parquet(f"{d}/wh/T2")
    assert sorted(r["table_name"] for r in list_tables(spark, f"{d}/wh").collect()) == ["T1", "T2"]
    counts = {r["table_name"]: r["rows"] for r in table_counts(warehouse_tables(spark, f"{d}/wh")).collect()}
    assert counts == {"T1": 3, "T2": 5}


def test_period_grid_order_clamp_and_empty(spark):
    from voltline.plans.acquire import period_grid

    g = [(r["year"], r["month"]) for r in period_grid(spark, 2025, 2030, [1, 3, 2], "https://b/", current_year=2026).collect()]
    assert g == [(2026, 3), (2026, 2), (2026, 1), (2025, 3), (2025, 2), (2025, 1)]
    assert period_grid(spark, 2027, 2030, [1], "https://b/", current_year=2026).count() == 0
    url = period_grid(spark, 2026, 2026, [1], "https://b/").first()["url"]
    assert url == "https://b/2026/MMSDM_2026_01/MMSDM_Historical_Data_SQLLoader/DATA/"


def _late_broadcast(spark, rows, names, key):
    """``rows`` joined on ``key`` with few ``names``: planned as a shuffled join, found to be a broadcast one at run time."""
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(old, ("-1", "10m", "false")):
        spark.conf.set(k, v)

    def back():
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return rows.join(names, key, "left_semi"), back


def test_files_of_joined_lines_are_written_by_one_task_each(spark):
    d = tempfile.mkdtemp(prefix="run-")
    lines = spark.range(0, 40_000, 1, 4).select(
        F.concat(F.lit("f"), F.col("id") % 3, F.lit(".csv")).alias("file_name"), F.lit(0).cast("bigint").alias("block_start"),
        F.col("id").alias("line_id"), F.concat(F.lit("D,X,Y,1,"), F.col("id")).alias("value"))
    names = spark.range(0, 1000, 1, 2).select(F.concat(F.lit("f"), F.col("id") % 3, F.lit(".csv")).alias("file_name")).distinct()
    joined, back = _late_broadcast(spark, lines, names, "file_name")
    try:
        told = {r["file_name"]: r["lines"] for r in write_report_files(joined, d).collect()}
    finally:
        back()
    for k in range(3):
        with open(f"{d}/f{k}.csv") as f:
            assert f.read().splitlines() == [f"D,X,Y,1,{i}" for i in range(k, 40_000, 3)]
    assert told == {f"f{k}.csv": len(range(k, 40_000, 3)) for k in range(3)}


def test_archives_of_joined_rows_are_written_by_one_task_each(spark):
    d = tempfile.mkdtemp(prefix="run-")
    rows = spark.range(0, 3_000, 1, 4).select(
        F.concat(F.lit("a"), F.col("id") % 3, F.lit(".zip")).alias("archive"), F.lit(None).cast("string").alias("inner"),
        F.concat(F.lit("m"), F.col("id")).alias("member"), F.encode(F.col("id").cast("string"), "UTF-8").alias("data"))
    names = spark.range(0, 1000, 1, 2).select(F.concat(F.lit("a"), F.col("id") % 3, F.lit(".zip")).alias("archive")).distinct()
    joined, back = _late_broadcast(spark, rows, names, "archive")
    try:
        write_zip_archives(joined, d).collect()
    finally:
        back()
    for k in range(3):
        with zipfile.ZipFile(f"{d}/a{k}.zip") as z:
            assert sorted(z.namelist()) == sorted(f"m{i}" for i in range(k, 3_000, 3))
