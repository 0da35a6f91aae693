"""Queries over whole jobs: SQL on stored tables, many layouts, archives, streams and replays (as ``derived``, inputs from the driver's tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltline.operators.render import render_report_lines, write_report_files
from voltline.plans.derived import _damaged_load, staged, table, ym, ymd
from voltline.session import materialize, scratch_dir

STORED_SQL = """
WITH busy AS (SELECT user_id, count(*) AS n, max(value) AS top FROM EVENTS GROUP BY user_id),
     nation AS (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY c_nationkey)
SELECT customer.c_mktsegment, nation.k AS nation_key, max(nation.customers) AS customers, sum(busy.n)::BIGINT AS events, max(busy.top) AS top_value
FROM customer JOIN busy ON busy.user_id = customer.c_custkey JOIN nation ON nation.k = customer.c_nationkey
WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = customer.c_custkey AND e.event_id % 2 = 0)
GROUP BY customer.c_mktsegment, nation.k"""


def q_sql_stored_tables(spark, sf_dir):
    """Q1 by name: tables loaded into a warehouse, joined by their names; a WITH entry hides the stored nation table."""
    from voltline.catalog import TableModel
    from voltline.operators.load import load_batch
    from voltline.plans.sql import run_sql

    warehouse = scratch_dir(spark, "stored")
    for name, key in (("events", "event_id"), ("customer", "c_custkey"), ("nation", "n_nationkey")):
        load_batch(spark, table(spark, sf_dir, name), f"{warehouse}/{name.upper()}", TableModel(name.upper(), (key,)))
    return run_sql(spark, STORED_SQL, warehouse=warehouse)


def q_list_tables(spark, sf_dir):
    """Q2 + A1: tables found in a warehouse folder (rejects beside them are none) with their counts."""
    from voltline.operators.load import write_rejects
    from voltline.plans.sql import list_tables, table_counts, warehouse_tables

    warehouse = scratch_dir(spark, "listed")
    for name in ("region", "nation", "supplier", "customer", "part"):
        table(spark, sf_dir, name).write.parquet(f"{warehouse}/{name.upper()}")
    write_rejects(warehouse, table(spark, sf_dir, "region").select(F.col("r_name").alias("row")), "regions", "1")
    return list_tables(spark, warehouse).join(table_counts(warehouse_tables(spark, warehouse)), "table_name")


def _many_layout_lines(spark, sf_dir):
    """Orders in a file per month, each with a header of its own: two column orders, and one month with a name twice."""
    o = table(spark, sf_dir, "orders")
    month = ym("o_orderdate")
    odd = F.month("o_orderdate") % 2 == 1
    fname = F.concat(F.when(odd, "PUBLIC_DVD_TRADINGREGIONSUM_").otherwise("orders_"), month, F.lit("010000.CSV"))
    short, long = F.concat_ws(",", "o_orderkey", "o_custkey", "o_totalprice"), F.concat_ws(",", "o_custkey", F.concat(F.lit('"'), "o_orderpriority", F.lit(', x"')), "o_orderkey", "o_totalprice")
    data = o.select(fname.alias("file_name"), F.col("o_orderkey").alias("line_id"), F.concat(F.lit("D,ORD,O,"), month, F.lit(","), F.when(odd, short).otherwise(long)).alias("value"), month.alias("month"), odd.alias("odd"))
    named = F.when(F.col("odd"), "o_orderkey,o_custkey,o_totalprice").when(F.col("month") == "199602", "o_custkey,o_custkey,o_orderkey,o_totalprice").otherwise("o_custkey,o_orderpriority,o_orderkey,O_TotalPrice")
    heads = data.select("file_name", "month", "odd").distinct().select("file_name", F.lit(-1).cast("bigint").alias("line_id"), F.concat(F.lit("I,ORD,O,"), "month", F.lit(","), named).alias("value"))
    return staged(data.select("file_name", "line_id", "value").unionByName(heads).select(
        F.concat(F.lit("inbox/"), "file_name").alias("source_file"), "file_name", F.lit(0).cast("bigint").alias("block_start"), "line_id", "value"))


def q_parse_layouts(spark, sf_dir):
    """P6 in one pass: as many layouts as months, split once, read by table; a bad header fails its own file alone."""
    from voltline.functions.names import route_table
    from voltline.operators.infer import apply_types, infer_types
    from voltline.operators.report import parse_report

    lines = _many_layout_lines(spark, sf_dir)
    routes = lines.select("source_file", "file_name").distinct().select("source_file", route_table("file_name").alias("table_name"))
    report = parse_report(lines).stage(routes)
    out = None
    for name in sorted(report.columns):
        rows = report.rows(name)
        rows = apply_types(rows, infer_types(rows, report.columns[name])).select(F.lit(name).alias("table_name"), *report.columns[name])
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("table_name", "o_orderkey", "o_custkey", F.col("o_totalprice").alias("o_totalprice"), "o_orderpriority")


def q_archive_window(spark, sf_dir):
    """G6 + S3, S4: documents in zips of two levels, archives outside the window pruned unread, members in small chunks of lines."""
    from voltline.plans.acquire import extract_window
    from voltline.sources.archives import archive_paths, write_zip_archives
    from voltline.sources.members import chunk_lines, member_chunks

    d = table(spark, sf_dir, "documents")
    k = F.floor(F.col("doc_id") / 20)
    period = F.format_string("%04d%02d", (2020 + k % 5).cast("int"), (1 + k % 12).cast("int"))
    rows = d.select(
        F.concat(F.lit("PUBLIC_DVD_DOCS_"), period, F.lit("010000_"), k.cast("string"), F.lit(".zip")).alias("archive"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("PART_"), F.col("doc_id").cast("string"), F.lit(".zip"))).otherwise("").alias("inner"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"),
        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"),
    )
    out = scratch_dir(spark, "archives")
    write_zip_archives(rows, out).count()
    chunks = materialize(member_chunks(archive_paths(spark, out, file_filter=extract_window(2021, 2023, range(1, 7))), suffix=".txt", chunk_bytes=1000), "member-chunks")
    return chunk_lines(chunks).groupBy(F.col("file_name").alias("member")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars"), F.max(F.length("value")).alias("longest"))


def _event_archives(spark, sf_dir, out):
    """Events as report files of a day, zipped by month."""
    from voltline.sources.archives import write_zip_archives

    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "user_id", "value")
    fname = F.concat(F.lit("PUBLIC_DVD_EVENTS_"), ymd("event_time"), F.lit("0000.CSV"))
    lines = render_report_lines(e, fname, F.col("event_id"), report="EVENTS", sub_report="EVENTS")
    text = lines.groupBy("file_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_id", "value"))), lambda x: x["value"]), "\n").alias("text"))
    write_zip_archives(text.select(
        F.concat(F.lit("PUBLIC_DVD_EVENTS_"), F.regexp_extract("file_name", r"(\d{6})\d{2}0000", 1), F.lit("010000.zip")).alias("archive"), F.lit("").alias("inner"),
        F.col("file_name").alias("member"), F.encode("text", "UTF-8").alias("data")), out).count()


def q_run_job(spark, sf_dir):
    """G1: listing pages planned, zipped reports of the window expanded and loaded, in one call; a second call loads nothing more."""
    from voltline.plans.job import run_job
    from voltline.plans.load import LoadOptions

    root = scratch_dir(spark, "job")
    _event_archives(spark, sf_dir, f"{root}/zips")
    pages = spark.createDataFrame([(1, "https://example.test/now/", '<a href="PUBLIC_DVD_EVENTS_203001010000.zip">x</a>')], "page_id bigint, url string, html string")
    opts = LoadOptions(start_year=1900, end_year=2100, months=tuple(range(1, 13, 2)))
    for _ in range(2):
        run_job(spark, "current", pages, f"{root}/zips", f"{root}/wh", f"{root}/ledger", opts, root_url="https://example.test/now/")
    return spark.read.parquet(f"{root}/wh/OTHER_DATA").select("event_id", "event_time", "user_id", "value", F.substring_index("_source_file", "/", -1).alias("file_name"))


def q_load_rejects_replayed(spark, sf_dir):
    """D3, V4: a damaged batch loaded again leaves the rejects as they were."""
    from voltline.operators.load import read_rejects

    warehouse, _ = _damaged_load(spark, sf_dir, times=3)
    return read_rejects(spark, warehouse).groupBy("table_name", "source_file", "reason").agg(F.count(F.lit(1)).alias("rows"))


ROOT_PAGE = "https://example.test/feed/"


def _day_links(spark, sf_dir):
    """A link to an archive for each day that has orders."""
    o = table(spark, sf_dir, "orders")
    days = o.groupBy(ymd("o_orderdate").alias("day")).agg(F.min("o_orderkey").alias("first_key"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))
    return days.select("day", "first_key", "finished", F.concat(F.lit("PUBLIC_ORDERS_"), "day", F.lit("0000.zip")).alias("file_name"))


def _feed_pages(links):
    """One page per month with its days' links."""
    anchor = F.concat(F.lit('<a href="'), "file_name", F.lit('">'), "day", F.lit("</a>"))
    html = F.concat_ws("\n", F.sort_array(F.collect_list(anchor)))
    return links.groupBy(F.substring("day", 1, 6).alias("month")).agg(html.alias("html"))


def q_plan_current(spark, sf_dir):
    """G5 + F14: without feeds the root page is one; links of days already local are left out."""
    from voltline.plans.acquire import plan_downloads

    links = materialize(_day_links(spark, sf_dir), "day-links")
    pages = _feed_pages(links).select(F.col("month").alias("page_id"), F.lit(ROOT_PAGE).alias("url"), "html")
    local = links.filter("finished > 2").select("file_name")
    empty = spark.createDataFrame([], "table_name string, year int, month int, source_file string")
    return plan_downloads(spark, "current", pages, empty, local, root_url=ROOT_PAGE).select("url", "file_name", "feed").distinct()


def q_plan_archive(spark, sf_dir):
    """A feed's links by pattern and window; months whose tables the ledger holds, and local files, are left out."""
    from voltline.plans.acquire import plan_downloads

    links = materialize(_day_links(spark, sf_dir), "day-links")
    pages = _feed_pages(links).select(F.col("month").alias("page_id"), F.lit(ROOT_PAGE).alias("url"), "html")
    month = links.select(F.substring("day", 1, 4).cast("int").alias("year"), F.substring("day", 5, 2).cast("int").alias("month"), "first_key")
    ledger = month.groupBy("year", "month").agg(F.min("first_key").alias("k")).select(
        F.explode(F.when(F.col("k") % 3 == 0, F.array(F.lit("dispatchprice"), F.lit("tradingprice"))).otherwise(F.array(F.lit("dispatchprice")))).alias("table_name"), "year", "month", F.lit("x").alias("source_file"))
    feeds = [{"name": "one", "url": ROOT_PAGE, "tables": ["DISPATCHPRICE", "TRADINGPRICE"], "include_patterns": ["orders_19"]}]
    local = links.filter("finished > 2").select("file_name")
    out = plan_downloads(spark, "archive", pages, ledger, local, feeds=feeds, start_year=1996, end_year=1998, months=[1, 2, 3, 4, 5, 6])
    return out.select("url", "file_name", "year", "month").distinct()


def q_stream_manifest(spark, sf_dir):
    """Listing pages land in two drops, some links twice; the manifest holds each link once."""
    from voltline.streaming.planner import start_manifest_stream

    root = scratch_dir(spark, "manifest")
    pages = materialize(_feed_pages(_day_links(spark, sf_dir)), "feed-pages")
    drops = [pages.filter(F.col("month") < "1998").withColumn("name", F.concat(F.lit("one_"), "month", F.lit(".html"))),
             pages.filter(F.col("month") >= "1997").withColumn("name", F.concat(F.lit("two_"), "month", F.lit(".html")))]
    urls = spark.createDataFrame([], "file_name string, url string")
    for drop in drops:
        urls = urls.unionByName(drop.select(F.col("name").alias("file_name"), F.lit(ROOT_PAGE).alias("url")))
    for i, drop in enumerate(drops):
        lines = drop.select(F.concat(F.lit("pages/"), "name").alias("source_file"), F.col("name").alias("file_name"), F.lit(0).cast("bigint").alias("block_start"),
                            F.lit(0).cast("bigint").alias("line_id"), F.col("html").alias("value"))
        write_report_files(lines, f"{root}/pages/drop{i}").count()
        start_manifest_stream(spark, f"{root}/pages/*", urls, f"{root}/manifest", f"{root}/ckpt", root_url=ROOT_PAGE).awaitTermination()
    return spark.read.parquet(f"{root}/manifest").select("url", "file_name")


def q_stream_load_keyed(spark, sf_dir):
    """T4 + J1: a keyed table loaded by a stream in two drops; the first row of a key wins, within a drop and across them."""
    from voltline.plans.load import LoadOptions
    from voltline.streaming.loader import start_stream_load

    root = scratch_dir(spark, "keyed")
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id") % 50).alias("DUID"), F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("START_DATE"), "event_id", "value",
        F.col("event_id").alias("k"), F.when(F.col("event_id") % 3 == 0, 0).otherwise(1).alias("drop"))
    opts = LoadOptions(start_year=1900, end_year=2100)
    for i in (0, 1):
        rows = e.filter(F.col("drop") == i)
        fname = F.concat(F.lit(f"PUBLIC_DVD_DUDETAILSUMMARY_2026010{i + 1}"), F.lpad((F.col("k") % 7).cast("string"), 4, "0"), F.lit(".CSV"))
        lines = staged(render_report_lines(rows.select("DUID", "START_DATE", "event_id", "value", "k"), fname, F.col("k"), report="DU", sub_report="SUMMARY"))
        write_report_files(lines, f"{root}/inbox/drop{i}").count()
        start_stream_load(spark, f"{root}/inbox", f"{root}/wh", f"{root}/ledger", f"{root}/ckpt", opts).awaitTermination()
    return spark.read.parquet(f"{root}/wh/DUDETAILSUMMARY").select("DUID", "START_DATE", "event_id", "value")


def q_stream_archives(spark, sf_dir):
    """Zips of reports land in an inbox; a stream reads their members in chunks and loads them."""
    from voltline.plans.load import LoadOptions
    from voltline.streaming.loader import start_stream_load

    root = scratch_dir(spark, "zipped")
    _event_archives(spark, sf_dir, f"{root}/zips")
    opts = LoadOptions(start_year=1900, end_year=2100)
    for _ in range(2):  # the second run finds nothing new
        start_stream_load(spark, f"{root}/zips", f"{root}/wh", f"{root}/ledger", f"{root}/ckpt", opts, archives=True).awaitTermination()
    return spark.read.parquet(f"{root}/wh/OTHER_DATA").select("event_id", "event_time", "user_id", "value", F.substring_index("_source_file", "/", -1).alias("file_name"))


def _summaries(spark, sf_dir):
    """Events as rows of a table keyed by a unit and a time."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id") % 20).alias("DUID"), F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("START_DATE"), "event_id",
        F.concat(F.lit("f"), F.col("event_id") % 7).alias("_source_file"), F.lit(0).cast("bigint").alias("_block_start"), F.col("event_id").alias("_line_id"), F.dayofmonth("ts").alias("day"))


def q_load_periods(spark, sf_dir):
    """K2 + J1 on a table split by the month of its key time: two loads that overlap, then the table with its periods."""
    from voltline.catalog import table_model
    from voltline.operators.load import load_batch
    from voltline.operators.store import PERIOD, read_table

    path = f"{scratch_dir(spark, 'periods')}/DUDETAILSUMMARY"
    rows = _summaries(spark, sf_dir)
    for some in (rows.filter("day <= 12"), rows.filter("day >= 10")):
        load_batch(spark, some.drop("day"), path, table_model("DUDETAILSUMMARY"))
    return read_table(spark, path).select("DUID", "START_DATE", "event_id", F.col(PERIOD).alias("period"))


def q_align_schema_add(spark, sf_dir):
    """E2 with the schema log: a second load adds a column; the table's reader shows it, NULL in older rows."""
    from voltline.catalog import TableModel
    from voltline.operators.load import load_batch
    from voltline.operators.store import read_table

    path = f"{scratch_dir(spark, 'widened')}/CUSTOMER"
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    model = TableModel("CUSTOMER", ("c_custkey",))
    load_batch(spark, c.filter("c_custkey % 3 = 0").select("c_custkey", "c_name"), path, model)
    load_batch(spark, c.filter("c_custkey % 3 <= 1"), path, model, extra="add")
    load_batch(spark, c, path, model)
    return read_table(spark, path)


def q_schema_history(spark, sf_dir):
    """Every version of a table's schema as its log has it."""
    from voltline.catalog import TableModel
    from voltline.operators.load import load_batch
    from voltline.operators.store import schema_history

    path = f"{scratch_dir(spark, 'history')}/CUSTOMER"
    c = table(spark, sf_dir, "customer")
    for columns in (["c_custkey", "c_name"], ["c_custkey", "c_name", "c_acctbal"], ["c_custkey", "c_mktsegment", "c_nationkey"]):
        load_batch(spark, c.select(columns), path, TableModel("CUSTOMER", ("c_custkey",)), extra="add")
    return schema_history(spark, path)


def _event_texts(spark, sf_dir):
    """Events as text rows of files whose values differ in kind: whole numbers, decimals, words or nothing; times in two layouts."""
    e = table(spark, sf_dir, "events")
    f = F.col("user_id") % 5
    day = F.regexp_replace(F.substring(F.col("ts").cast("string"), 1, 10), "-", "/")
    time = F.substring(F.col("ts").cast("string"), 1, 19)
    slashed = (F.col("event_id") + f) % 3 == 0
    return e.select(
        F.concat(F.lit("file"), f).alias("_source_file"), F.lit(0).cast("bigint").alias("_block_start"), F.col("event_id").alias("_line_id"), F.col("event_id").cast("string").alias("event_id"),
        F.when(f == 0, F.col("user_id").cast("string")).when(f == 1, F.col("value").cast("string")).when(f == 2, F.when(F.col("event_id") % 2 == 0, "true").otherwise("False")).when(f == 3, F.col("event_type")).alias("measure"),
        F.when(F.col("event_id") % 11 != 5, F.when(slashed, day).otherwise(time)).alias("EVENT_TIME"))


def q_infer_types_by_file(spark, sf_dir):
    """P8 per file: types of each file's columns, from one aggregate over all files."""
    from voltline.operators.infer import infer_types_by_file

    return infer_types_by_file(_event_texts(spark, sf_dir), ["event_id", "measure", "EVENT_TIME"])


def q_coerce_datetime_first_format(spark, sf_dir):
    """P9 by one format: each file's first time decides the layout that its column is read by."""
    from voltline.operators.infer import coerce_first_format

    rows = coerce_first_format(_event_texts(spark, sf_dir), ["EVENT_TIME"], ["_block_start", "_line_id"])
    return rows.select(F.col("_source_file").alias("file_name"), "event_id", F.col("EVENT_TIME").alias("event_time"))


def q_stream_archive_files(spark, sf_dir):
    """K4: reports land in two drops; the stream moves those of committed batches, and the last ones when it has ended."""
    from voltline.plans.load import LoadOptions
    from voltline.sources.lines import list_files
    from voltline.streaming.loader import start_stream_load
    from voltline.streaming.settle import settle_files

    root = scratch_dir(spark, "settled")
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "value")
    fname = F.concat(F.lit("PUBLIC_DVD_EVENTS_"), ymd("event_time"), F.lit("0000.CSV"))
    lines = staged(render_report_lines(e, fname, F.col("event_id"), report="EVENTS", sub_report="EVENTS"))
    opts = LoadOptions(start_year=1900, end_year=2100, months=tuple(range(1, 12)))  # December stays in the inbox
    early = F.regexp_extract("file_name", r"\d{6}(\d{2})0000", 1) <= "15"
    for i, drop in enumerate((lines.filter(early), lines.filter(~early))):
        write_report_files(drop, f"{root}/inbox/drop{i}").count()
        query = start_stream_load(spark, f"{root}/inbox", f"{root}/wh", f"{root}/ledger", f"{root}/ckpt", opts, archive_dir=f"{root}/done")
        query.awaitTermination()
    settle_files(spark, f"{root}/wh", f"{root}/inbox", f"{root}/done", query.id)
    places = [list_files(spark, f"{root}/{p}", "*.CSV").select(F.lit(p).alias("place"), F.regexp_extract("source_file", r"/(drop\d)/", 1).alias("drop"), "file_name") for p in ("inbox", "done")]
    return places[0].unionByName(places[1])


def q_period_grid_now(spark, sf_dir):
    """without a year given the grid ends with this one; the start is the first year that has orders."""
    from voltline.plans.acquire import period_grid

    bounds = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("s"))
    return period_grid(spark, F.col("s"), 2999, [12, 1], "https://example.test/MMSDM/", source=bounds)


ODD_SQL = "SELECT `c key` AS c_custkey, `a.b` AS c_name, `tick``s` AS c_acctbal, upper(`SELECT`) AS segment FROM other_data WHERE `c key` % 2 = 0"


def q_load_quoted_names(spark, sf_dir):
    """Quoted identifiers: a report whose columns have a blank, a dot, a back-tick and a keyword as names, loaded, then asked in SQL."""
    from voltline.plans.load import LoadOptions, load_lines
    from voltline.plans.sql import run_sql

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c key"), F.col("c_name").alias("a.b"), F.col("c_acctbal").alias("tick`s"), F.col("c_mktsegment").alias("SELECT"))
    data = c.select(F.concat_ws(",", F.lit("D,CUST,OMER,1"), F.col("`c key`"), F.col("`a.b`"), F.col("`tick``s`"), F.col("`SELECT`")).alias("value"), F.col("`c key`").alias("line_id"))
    head = spark.range(1).select(F.lit("I,CUST,OMER,1,c key,a.b,tick`s,SELECT").alias("value"), F.lit(-1).cast("bigint").alias("line_id"))
    lines = staged(data.unionByName(head).select(F.lit("inbox/customers.csv").alias("source_file"), F.lit("customers.csv").alias("file_name"), F.lit(0).cast("bigint").alias("block_start"), "line_id", "value"))
    routes = spark.createDataFrame([("inbox/customers.csv", "other_data", 2026, 1)], "source_file string, table_name string, year int, month int")
    warehouse = scratch_dir(spark, "quoted")
    load_lines(spark, lines, routes, warehouse, None, LoadOptions())
    return run_sql(spark, ODD_SQL, warehouse=warehouse)
