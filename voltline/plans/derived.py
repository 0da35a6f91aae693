"""Queries over the driver's tables: every report-shaped input is derived from them by Spark.

Each function takes (spark, sf_dir) and returns a DataFrame; ``__spark_entry__`` registers them and
``voltline.plans.oracle`` holds the equivalent DuckDB SQL. All rows of every table are used: the
derivations only decide *how* a row is rendered (file, naming style, damage), never *whether*.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline import catalog
from voltline.functions.names import in_period, period_first8, period_strict, route_table
from voltline.functions.text import drop_invalid_utf8
from voltline.functions.timestamps import parse_market_timestamp
from voltline.operators.align import align_schema, cast_to_target
from voltline.operators.dedupe import anti_join_new, dedupe_first, pk_audit
from voltline.operators.infer import apply_types, infer_types
from voltline.operators.render import render_report_lines, write_report_files
from voltline.operators.report import parse_report, tag_lines
from voltline.session import materialize, scratch_dir
from voltline.sources.lines import read_report_lines

# Naming parameters of the derived report files.
NAMING_TABLES = list(catalog.ROUTABLE_TABLES) + ["UNLISTED"]
WINDOW = (1996, 1999, (1, 2, 3))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ym(ts: str | Column) -> Column:
    """yyyyMM of a TIMESTAMP_NTZ, zone-free (field extraction, not date_format)."""
    number = F.year(ts) * 100 + F.month(ts)
    return F.when(F.year(ts).between(1000, 9999), number.cast("string")).otherwise(F.format_string("%04d%02d", F.year(ts), F.month(ts)))


def ymd(ts: str | Column) -> Column:
    number = F.year(ts) * 10_000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return F.when(F.year(ts).between(1000, 9999), number.cast("string")).otherwise(F.format_string("%04d%02d%02d", F.year(ts), F.month(ts), F.dayofmonth(ts)))


def month_file(prefix: str, ts: str = "o_orderdate") -> Column:
    return F.concat(F.lit(prefix), ym(ts), F.lit("010000.CSV"))


def staged(lines: DataFrame) -> DataFrame:
    """Rendered lines written once (Parquet in the shared checkpoint folder), as files on disk would be.

    Without this the rendering expression would be re-evaluated wherever the parser filters on a
    value computed from the line."""
    return materialize(lines, "rendered-lines")


def orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return staged(render_report_lines(o, month_file("PUBLIC_DVD_ORDERS_"), F.col("o_orderkey"), report="ORDERS", sub_report="ORDERS"))


# --- parsing ---------------------------------------------------------------------------------

def q_parse_report(spark, sf_dir):
    """P2-P9 round trip: orders -> report lines -> typed rows."""
    parsed = parse_report(orders_lines(spark, sf_dir))
    rows = parsed.strings(0, lineage=False)
    return apply_types(rows, infer_types(rows, rows.columns))


def q_scan_report_lines(spark, sf_dir):
    """S1 + P2: orders written as report files, read back, lines counted per file and tag."""
    out = scratch_dir(spark, "scan")
    write_report_files(orders_lines(spark, sf_dir), out).count()
    tagged = tag_lines(read_report_lines(spark, out))
    return tagged.groupBy("file_name").agg(
        F.count_if(F.col("tag") == "I").alias("header_lines"),
        F.count_if(F.col("tag") == "D").alias("data_lines"),
        F.count_if(F.col("tag").isNull()).alias("other_lines"),
    )


def q_decode_lines(spark, sf_dir):
    """An invalid byte spliced into every document is dropped; the rest of the text survives."""
    d = table(spark, sf_dir, "documents")
    raw = F.concat(F.encode(F.substring("text", 1, 5), "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.expr("substring(text, 6)"), "UTF-8"))
    return d.select("doc_id", F.length(drop_invalid_utf8(raw.cast("string"))).alias("clean_chars"))


def _two_section_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    fname = month_file("PUBLIC_DVD_ORDERS_")
    first = F.dayofmonth("o_orderdate") <= 15
    data = o.select(
        fname.alias("file_name"),
        F.when(first, F.col("o_orderkey")).otherwise(F.lit(1 << 41) + F.col("o_orderkey")).alias("line_id"),
        F.when(first, F.concat_ws(",", F.lit("D,ORD,A,1"), "o_orderkey", "o_custkey"))
        .otherwise(F.concat_ws(",", F.lit("D,ORD,B,2"), "o_orderkey", "o_orderstatus")).alias("value"),
    )
    heads = data.select("file_name").distinct().select(
        "file_name",
        F.explode(F.array(
            F.struct(F.lit(-1).cast("bigint").alias("line_id"), F.lit("I,ORD,A,1,o_orderkey,o_custkey").alias("value")),
            F.struct(F.lit(1 << 40).cast("bigint").alias("line_id"), F.lit("I,ORD,B,2,o_orderkey,o_orderstatus").alias("value")),
        )).alias("h"),
    ).select("file_name", "h.line_id", "h.value")
    return staged(data.unionByName(heads).select(
        F.concat(F.lit("inbox/"), "file_name").alias("source_file"), "file_name",
        F.lit(0).cast("bigint").alias("block_start"), "line_id", "value",
    ))


def q_header_last_wins(spark, sf_dir):
    """P3 original rule: the last I line of a file names all of its D lines."""
    parsed = parse_report(_two_section_lines(spark, sf_dir), sections="last")
    rows = parsed.strings(0, lineage=False)
    return apply_types(rows, infer_types(rows, rows.columns))


def q_header_sections(spark, sf_dir):
    """P3 with V6: each D line is named by the nearest preceding I line."""
    parsed = parse_report(_two_section_lines(spark, sf_dir), sections="nearest")
    frames = []
    for lay in parsed.layouts:
        rows = parsed.strings(lay, lineage=False)
        frames.append(apply_types(rows, infer_types(rows, rows.columns)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select("o_orderkey", "o_custkey", "o_orderstatus")


def q_payload_offset(spark, sf_dir):
    """P5: the all-digit header field ends the prefix; its position differs per file (by region)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    cn = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])  # nation: 25 rows
    fname = F.concat(F.lit("CUST_"), F.col("n_nationkey").cast("string"), F.lit(".CSV"))
    pad = F.repeat(F.lit(",X"), F.col("n_regionkey"))
    data = cn.select(
        fname.alias("file_name"), F.col("c_custkey").alias("line_id"),
        F.concat(F.lit("D,CUSTOMER"), pad, F.lit(","), F.col("n_nationkey").cast("string"), F.lit(","),
                 F.concat_ws(",", "c_custkey", "c_name", "c_acctbal")).alias("value"),
    )
    heads = n.select(
        fname.alias("file_name"), F.lit(-1).cast("bigint").alias("line_id"),
        F.concat(F.lit("I,CUSTOMER"), pad, F.lit(","), F.col("n_nationkey").cast("string"), F.lit(",c_custkey,c_name,c_acctbal")).alias("value"),
    )
    lines = staged(data.unionByName(heads).select(
        F.concat(F.lit("inbox/"), "file_name").alias("source_file"), "file_name",
        F.lit(0).cast("bigint").alias("block_start"), "line_id", "value",
    ))
    parsed = parse_report(lines)
    frames = []
    for lay in parsed.layouts:
        rows = parsed.strings(lay).select(
            F.substring_index("_source_file", "/", -1).alias("file_name"),
            F.lit(lay.start_col).alias("start_col"), F.lit(lay.names[0]).alias("first_column"),
            F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("c_acctbal").cast("double").alias("c_acctbal"),
        )
        frames.append(rows)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("file_name", "start_col", "first_column").agg(
        F.count("*").alias("rows"), F.min("c_custkey").alias("min_custkey"), F.max("c_acctbal").alias("max_acctbal")
    )


def q_file_status(spark, sf_dir):
    """Per file status with damaged files derived from the calendar month."""
    o = table(spark, sf_dir, "orders")
    m, late = F.month("o_orderdate"), F.dayofmonth("o_orderdate") > 15
    base = F.concat_ws(",", F.lit("D,ORD,ORD,1"), "o_orderkey", "o_custkey", "o_totalprice")
    short = F.concat_ws(",", F.lit("D,ORD,ORD,1"), "o_orderkey", "o_custkey")
    value = (
        F.when(m == 4, F.concat(base, F.lit(",X")))
        .when((m == 5) & late, F.concat(base, F.lit(",X")))
        .when((m == 6) & late, short)
        .otherwise(base)
    )
    fname = month_file("PUBLIC_DVD_ORDERS_")
    data = o.select(fname.alias("file_name"), F.col("o_orderkey").alias("line_id"), value.alias("value"), m.alias("m"))
    header = F.when(F.col("m") == 3, F.lit("I,ORD,ORD,1,o_orderkey,,o_totalprice")).otherwise(F.lit("I,ORD,ORD,1,o_orderkey,o_custkey,o_totalprice"))
    heads = data.filter(F.col("m") != 2).select("file_name", "m").distinct().select(
        "file_name", F.lit(-1).cast("bigint").alias("line_id"), header.alias("value"), "m")
    lines = staged(data.unionByName(heads).select(
        F.concat(F.lit("inbox/"), "file_name").alias("source_file"), "file_name",
        F.lit(0).cast("bigint").alias("block_start"), "line_id", "value",
    ))
    return parse_report(lines).file_status().select("file_name", "status", "header_lines", "data_lines", "rows")


def q_infer_types(spark, sf_dir):
    """Types inferred from lineitem rendered as text."""
    li = table(spark, sf_dir, "lineitem")
    fname = F.concat(F.lit("PUBLIC_DVD_LINEITEM_"), ym("l_shipdate"), F.lit("010000.CSV"))
    order = F.col("l_orderkey") * 16 + F.col("l_linenumber")
    lines = staged(render_report_lines(li, fname, order, report="LINEITEM", sub_report="LINEITEM"))
    rows = parse_report(lines).strings(0, lineage=False)
    types = infer_types(rows, rows.columns)
    spec = [(c, i + 1, types[c].simpleString()) for i, c in enumerate(rows.columns)]
    # the inferred types are one aggregate over every row; attach them to the column list
    return spark.createDataFrame(spec, "column_name string, position int, inferred_type string")


def q_coerce_datetime(spark, sf_dir):
    """Event times rendered in two layouts, date only, or junk; parsed zone-free."""
    e = table(spark, sf_dir, "events")
    style = F.pmod("event_id", F.lit(4))
    iso = F.substring(F.col("ts").cast("string"), 1, 19)  # yyyy-MM-dd HH:mm:ss, zone-free
    text = (
        F.when(style == 0, F.regexp_replace(iso, "-", "/"))
        .when(style == 1, iso)
        .when(style == 2, F.regexp_replace(F.substring(iso, 1, 10), "-", "/"))
        .otherwise(F.concat(F.lit("not a time "), F.col("event_id").cast("string")))
    )
    return e.select("event_id", parse_market_timestamp(text).alias("ts_parsed"))


# --- file names --------------------------------------------------------------------------------

def named_files(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    t = F.element_at(F.array(*[F.lit(x) for x in NAMING_TABLES]), (F.pmod("o_custkey", F.lit(len(NAMING_TABLES))) + 1).cast("int"))
    day = ymd("o_orderdate")
    style = F.pmod("o_orderkey", F.lit(4))
    name = (
        F.when(style == 0, F.concat(F.lit("PUBLIC_DVD_"), t, F.lit("_"), day, F.lit("0000.CSV")))
        .when(style == 1, F.concat(F.lit("PUBLIC_ARCHIVE#"), t, F.lit("#FILE01#"), day, F.lit("0000.CSV")))
        .when(style == 2, F.concat(F.lit("PUBLIC_ARCHIVE%23"), t, F.lit("%23FILE01%23"), day, F.lit("0000.CSV")))
        .otherwise(F.concat(F.lower(t), F.lit(".csv")))
    )
    return o.select("o_orderkey", name.alias("file_name"), "o_orderstatus")


def q_route_table(spark, sf_dir):
    return named_files(spark, sf_dir).select("o_orderkey", "file_name", route_table("file_name").alias("table_name"))


def q_route_table_decoded(spark, sf_dir):
    return named_files(spark, sf_dir).select("o_orderkey", "file_name", route_table("file_name", decode=True).alias("table_name"))


def q_file_period_strict(spark, sf_dir):
    p = period_strict("file_name")
    return named_files(spark, sf_dir).select("o_orderkey", "file_name", p["year"].alias("year"), p["month"].alias("month"))


def q_file_period_first8(spark, sf_dir):
    p = period_first8("file_name")
    return named_files(spark, sf_dir).select("o_orderkey", "file_name", p["year"].alias("year"), p["month"].alias("month"))


def q_period_filter(spark, sf_dir):
    start, end, months = WINDOW
    return q_file_period_strict(spark, sf_dir).filter(in_period("year", "month", start, end, months))


# --- alignment, dedupe, keys -------------------------------------------------------------------

def q_align_schema(spark, sf_dir):
    """E1 + E2: a batch without c_acctbal and with an unknown column, aligned to the customer schema."""
    c = table(spark, sf_dir, "customer")
    batch = c.drop("c_acctbal").withColumn("c_comment", F.concat(F.lit("note "), F.col("c_name")))
    return align_schema(batch, c.schema).frame


def q_cast_to_target(spark, sf_dir):
    """Customer as text with unconvertible balances in some rows; those rows are rejected."""
    c = table(spark, sf_dir, "customer")
    text = c.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.when(F.pmod("c_custkey", F.lit(7)) == 0, F.lit("n/a-balance")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        "c_mktsegment",
    )
    good, _ = cast_to_target(text, c.schema)
    return good


def _lineitem_order():
    return ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def q_dedupe_first(spark, sf_dir):
    """First row per (l_orderkey, l_linenumber) in a total order over all columns."""
    li = table(spark, sf_dir, "lineitem")
    return dedupe_first(li, ["l_orderkey", "l_linenumber"], _lineitem_order())


def q_anti_join_new(spark, sf_dir):
    """Orders whose key is not yet present in lineitem."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return anti_join_new(o, li, ["o_orderkey"])


def q_pk_audit(spark, sf_dir):
    return pk_audit(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- ledger and acquisition planning -----------------------------------------------------------

BASE_URL = "https://example.test/MMSDM/"


def _named_periods(spark, sf_dir):
    """Derived file names with their route (decoded, lower case) and strict period."""
    n = named_files(spark, sf_dir)
    p = period_strict("file_name")
    return n.select(
        "o_orderkey", "o_orderstatus", "file_name",
        F.lower(route_table("file_name", decode=True)).alias("table_name"),
        p["year"].alias("year"), p["month"].alias("month"),
    )


def _ledger_from(named: DataFrame, status: str) -> DataFrame:
    return named.filter(F.col("o_orderstatus") == status).select(
        "table_name", "year", "month", F.col("file_name").alias("source_file"),
        F.lit(0).cast("bigint").alias("rows_loaded"), F.localtimestamp().alias("loaded_at"),
    )


def q_ledger_skip(spark, sf_dir):
    """F8 with the original month grain: ledger from finished orders' files, candidates from all files."""
    from voltline.operators.ledger import ledger_skip

    named = materialize(_named_periods(spark, sf_dir), "named-files")  # the file listing, written once
    cand = named.select(F.col("file_name").alias("source_file"), "table_name", "year", "month").distinct()
    kept = ledger_skip(cand, _ledger_from(named, "F"), grain="month")
    return kept.select(F.col("source_file").alias("file_name"), "table_name", "year", "month")


def q_ledger_mark(spark, sf_dir):
    """K3: open orders' files are marked in a ledger that already holds the finished ones."""
    from voltline.operators.ledger import ledger_mark

    named = _named_periods(spark, sf_dir)
    path = scratch_dir(spark, "ledger")
    _ledger_from(named, "F").dropDuplicates(["table_name", "year", "month", "source_file"]).write.parquet(path)
    new = ledger_mark(spark, path, _ledger_from(named, "O"))
    return new.select("table_name", "year", "month", "source_file")


def _orders_grid(spark, sf_dir):
    from voltline.plans.acquire import period_grid

    o = table(spark, sf_dir, "orders")
    bounds = o.agg(
        F.min(F.year("o_orderdate")).alias("s"), F.max(F.year("o_orderdate")).alias("e"),
        F.collect_set(F.month("o_orderdate")).alias("ms"),
    )
    return period_grid(spark, F.col("s"), F.col("e"), F.col("ms"), BASE_URL, current_year=2026, source=bounds)


def q_period_grid(spark, sf_dir):
    """F12 + F13: month grid spanning the orders' years and months."""
    return _orders_grid(spark, sf_dir)


def q_period_completeness(spark, sf_dir):
    """F6 + F9: a month is complete when every wanted table is loaded (open orders) or local (finished)."""
    from voltline.plans.acquire import local_month_tables, period_completeness

    named = _named_periods(spark, sf_dir)
    local = named.filter(F.col("o_orderstatus") == "F").select(
        F.regexp_replace(F.upper("file_name"), r"\.CSV$", ".ZIP").alias("file_name")
    ).distinct()
    covered_local = local_month_tables(local, catalog.DEFAULT_WANTED_TABLES)
    return period_completeness(_orders_grid(spark, sf_dir), _ledger_from(named, "O"), covered_local, catalog.DEFAULT_WANTED_TABLES)


FEEDS = (("dispatch", ("DISPATCHPRICE", "DISPATCHREGIONSUM"), ("DISPATCH",)), ("other", (), ()))


def q_feed_completeness(spark, sf_dir):
    """per archive link, whether all tables of its feed are loaded for its month."""
    from voltline.plans.acquire import feed_completeness

    named = _named_periods(spark, sf_dir)
    links = named.select("file_name", "year", "month").distinct().withColumn(
        "feed_tables",
        F.when(F.upper("file_name").contains("DISPATCH"), F.array(*[F.lit(t) for t in FEEDS[0][1]]))
        .otherwise(F.array().cast("array<string>")),
    )
    return feed_completeness(links, _ledger_from(named, "O"), catalog.DEFAULT_WANTED_TABLES)


def q_extract_links(spark, sf_dir):
    """Every anchor of every page outside comments/scripts, resolved against the page URL."""
    from voltline.sources.links import extract_links

    return extract_links(table(spark, sf_dir, "pages"), suffix=None)


FEED_PATTERNS = ("THE", "ION")


def q_feed_filter(spark, sf_dir):
    """links kept when their upper-cased file name contains one of the feed's patterns."""
    from voltline.plans.acquire import include_filter
    from voltline.sources.links import extract_links

    links = extract_links(table(spark, sf_dir, "pages"), suffix=None)
    return links.filter(include_filter(F.col("file_name"), FEED_PATTERNS)).select("page_id", "position", "file_name")


def _listing_pages(spark, sf_dir):
    """One listing page per order, linking its archive name (decoys inside a comment and a script)."""
    from voltline.plans.acquire import month_url

    n = named_files(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    n = n.join(o, "o_orderkey")
    href = F.regexp_replace("file_name", r"(?i)\.csv$", ".zip")
    html = F.concat(
        F.lit('<html><body><!-- <a href="PUBLIC_DVD_DISPATCHPRICE_202601010000.zip">old</a> -->'),
        F.lit('<script>var a = \'<a href="PUBLIC_DVD_TRADINGPRICE_202601010000.zip">\';</script>'),
        F.lit('<a href="'), href, F.lit('">'), F.col("o_orderkey").cast("string"), F.lit("</a></body></html>"),
    )
    url = month_url(BASE_URL, F.year("o_orderdate"), F.month("o_orderdate"))
    return n.select(F.col("o_orderkey").alias("page_id"), url.alias("url"), html.alias("html"), "o_orderstatus", href.alias("href"))


def q_link_manifest(spark, sf_dir):
    """G3 link stage: name match (F5), ledger skip by period (F8), already-local skip."""
    from voltline.plans.acquire import link_manifest

    pages = materialize(_listing_pages(spark, sf_dir), "listing-pages")  # fetched pages, written once
    named = _named_periods(spark, sf_dir)
    local = pages.filter(F.col("o_orderstatus") == "F").select(F.col("href").alias("file_name"))
    out = link_manifest(pages.select("page_id", "url", "html"), catalog.DEFAULT_WANTED_TABLES, _ledger_from(named, "P"), local)
    return out.select("page_id", "url", "file_name", "table_name", "year", "month")


FEW_TABLES = ("DISPATCHPRICE", "TRADINGPRICE")


def q_plan_mmsdm(spark, sf_dir):
    """G3 whole: grid over the orders' months, complete months left out, their pages' links matched, skipped, planned."""
    from voltline.plans.acquire import plan_downloads

    pages = materialize(_listing_pages(spark, sf_dir), "listing-pages")
    local = pages.filter(F.col("o_orderstatus") == "P").select(F.col("href").alias("file_name"))
    o = table(spark, sf_dir, "orders")
    bounds = o.agg(
        F.min(F.year("o_orderdate")).alias("s"), F.max(F.year("o_orderdate")).alias("e"), F.collect_set(F.month("o_orderdate")).alias("ms"),
    )
    out = plan_downloads(
        spark, "mmsdm", pages.select("page_id", "url", "html"), _ledger_from(_named_periods(spark, sf_dir), "P"), local, tables=FEW_TABLES,
        start_year=F.col("s"), end_year=F.col("e"), months=F.col("ms"), base_url=BASE_URL, current_year=2026, grid_source=bounds,
    )
    return out.select("page_id", "url", "file_name", "table_name")


# --- load, stream, archives ---------------------------------------------------------------------

def _events_lines(spark, sf_dir, copy: str = "A"):
    # the report names the time column EVENT_TIME, so the loader coerces it (a column named ts stays text)
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "user_id", "event_type", "value", "props")
    fname = F.concat(F.lit(f"PUBLIC_DVD_EVENTS_{copy}_"), ymd("event_time"), F.lit("0000.CSV"))
    return e, staged(render_report_lines(e, fname, F.col("event_id"), report="EVENTS", sub_report="EVENTS", directory=f"inbox{copy}"))


def _events_typed(lines: DataFrame, infer: bool = True):
    """Parsed events rows: typed by inference (table creation) or left as text for the target's cast."""
    parsed = parse_report(lines)
    rows = parsed.strings(0)
    if not infer:
        return rows
    data_cols = [c for c in rows.columns if not c.startswith("_")]
    return apply_types(rows, infer_types(rows, data_cols))


def _events_load(spark, sf_dir):
    from voltline.catalog import TableModel
    from voltline.operators.load import load_batch

    model = TableModel("EVENTS", ("event_id",))
    path = scratch_dir(spark, "events-table")
    e, lines_a = _events_lines(spark, sf_dir, "A")
    early = lines_a.join(
        e.filter(F.dayofmonth("event_time") <= 15).select(F.col("event_id").alias("line_id")), "line_id", "left_semi"
    ).unionByName(lines_a.filter(F.col("line_id") < 0))
    first = load_batch(spark, _events_typed(early), path, model)
    _, lines_b = _events_lines(spark, sf_dir, "B")
    both = _events_typed(lines_a.unionByName(lines_b), infer=False)  # the table exists: cast to its types
    second = load_batch(spark, both, path, model)
    return path, first, second


def q_load_batch(spark, sf_dir):
    """First load the first half of each month, then all events twice; the table ends exact."""
    path, _, _ = _events_load(spark, sf_dir)
    return spark.read.parquet(path).drop("_source_file")


def q_load_metrics(spark, sf_dir):
    """D3: counters of the second load (in, duplicates in batch, already present, loaded)."""
    _, _, second = _events_load(spark, sf_dir)
    return spark.createDataFrame(
        [(second.rows_in, second.dup_in_batch, second.already_present, second.rows_loaded)],
        "rows_in bigint, dup_in_batch bigint, already_present bigint, rows_loaded bigint",
    )


def q_load_first_file(spark, sf_dir):
    """K1: the table created from the first load has the inferred schema."""
    path, _, _ = _events_load(spark, sf_dir)
    fields = [f for f in spark.read.parquet(path).schema.fields if not f.name.startswith("_")]
    return spark.createDataFrame([(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(fields)],
                                 "column_name string, position int, data_type string")


def _damaged_load(spark, sf_dir, times: int = 1):
    """Even events loaded first; then all as text, some with a value that is no number, no time or no key (``times`` over)."""
    from voltline.catalog import TableModel
    from voltline.operators.load import load_batch

    warehouse = scratch_dir(spark, "damaged")
    model = TableModel("EVENTS", ("event_id",))
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "value", F.concat(F.lit("f"), F.col("event_id") % 10).alias("_source_file"))
    load_batch(spark, e.filter(F.col("event_id") % 2 == 0), f"{warehouse}/EVENTS", model)
    text = e.select(
        F.when(F.col("event_id") % 7 != 0, F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("event_id") % 3 == 0, "junk").otherwise(F.col("event_time").cast("string")).alias("event_time"),
        F.when(F.col("event_id") % 5 == 0, "abc").otherwise(F.col("value").cast("string")).alias("value"), "_source_file",
    )
    for _ in range(times):
        report = load_batch(spark, text, f"{warehouse}/EVENTS", model)
    return warehouse, report


def q_load_rejects(spark, sf_dir):
    """Rows of a damaged load that could not be loaded, by file and reason."""
    from voltline.operators.load import read_rejects

    warehouse, _ = _damaged_load(spark, sf_dir)
    return read_rejects(spark, warehouse).groupBy("table_name", "source_file", "reason").agg(F.count(F.lit(1)).alias("rows"))


def q_load_balance(spark, sf_dir):
    """D3: every row of a damaged load is loaded, present, a duplicate or rejected."""
    _, r = _damaged_load(spark, sf_dir)
    return spark.createDataFrame([(r.rows_in, r.rejected, r.dup_in_batch, r.already_present, r.rows_loaded)],
                                 "rows_in bigint, rejected bigint, dup_in_batch bigint, already_present bigint, rows_loaded bigint")


def q_load_second_batch_dates(spark, sf_dir):
    """Text that is no time is NULL in a later load too."""
    warehouse, _ = _damaged_load(spark, sf_dir)
    return spark.read.parquet(f"{warehouse}/EVENTS").drop("_source_file")


def q_load_inbox(spark, sf_dir):
    """G7 + S1: events in files of awkward names (%23, #, +, blank, brackets), loaded from the folder into one table."""
    from voltline.plans.load import LoadOptions, load_inbox

    root = scratch_dir(spark, "inbox")
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "value")
    names = F.array(*[F.lit(n) for n in ("a%23b%231.csv", "a#b#2.csv", "c+d 3.csv", "report[4].csv", "report4.csv")])
    fname = F.element_at(names, (F.col("event_id") % 5 + 1).cast("int"))
    lines = staged(render_report_lines(e, fname, F.col("event_id"), report="EVENTS", sub_report="EVENTS"))
    write_report_files(lines, f"{root}/in").count()
    load_inbox(spark, f"{root}/in", f"{root}/wh", f"{root}/ledger", LoadOptions(start_year=1900, end_year=2100))
    rows = spark.read.parquet(f"{root}/wh/OTHER_DATA")
    return rows.select("event_id", "event_time", "value", F.substring_index("_source_file", "/", -1).alias("file_name"))


def q_stream_load(spark, sf_dir):
    """Events files land in an inbox in two drops; an availableNow stream loads each drop."""
    from voltline.plans.load import LoadOptions
    from voltline.streaming.loader import start_stream_load

    root = scratch_dir(spark, "stream")
    e, lines = _events_lines(spark, sf_dir, "A")
    early_ids = e.filter(F.dayofmonth("event_time") <= 15).select(F.col("event_id").alias("line_id"))
    early_files = lines.join(early_ids, "line_id", "left_semi").select("file_name").distinct()
    first = lines.join(early_files, "file_name", "left_semi")
    second = lines.join(early_files, "file_name", "left_anti")
    opts = LoadOptions(start_year=1900, end_year=2100)
    for i, drop in enumerate((first, second)):
        write_report_files(drop, f"{root}/inbox/drop{i}").count()
        q = start_stream_load(spark, f"{root}/inbox", f"{root}/wh", f"{root}/ledger", f"{root}/ckpt", opts)
        q.awaitTermination()
    return spark.read.parquet(f"{root}/wh/OTHER_DATA").drop("_source_file")


def q_expand_archives(spark, sf_dir):
    """Documents zipped two levels deep, expanded on the executors, text length per member."""
    from voltline.sources.archives import expand_archives, read_archives, write_zip_archives

    d = table(spark, sf_dir, "documents")
    rows = d.select(
        F.concat(F.lit("DOCS_"), F.floor(F.col("doc_id") / 100).cast("string"), F.lit(".zip")).alias("archive"),
        F.concat(F.lit("PART_"), F.floor(F.col("doc_id") / 10).cast("string"), F.lit(".zip")).alias("inner"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"),
        F.encode("text", "UTF-8").alias("data"),
    )
    out = scratch_dir(spark, "archives")
    write_zip_archives(rows, out).count()
    members = expand_archives(read_archives(spark, out))
    return members.select(
        F.substring_index("member", "/", -1).alias("member"), "depth",
        F.length(F.col("content").cast("string")).alias("n_chars"),
    )


# --- catalogue and SQL pass-through --------------------------------------------------------------

ALL_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def q_table_counts(spark, sf_dir):
    from voltline.plans.sql import table_counts

    return table_counts({t: table(spark, sf_dir, t) for t in ALL_TABLES})


def q_describe_tables(spark, sf_dir):
    from voltline.plans.sql import describe_tables

    return describe_tables(spark, {t: table(spark, sf_dir, t) for t in ALL_TABLES})


def _sql(spark, sf_dir, text: str, names: list[str]):
    from voltline.plans.sql import run_sql

    return run_sql(spark, text, **{n: table(spark, sf_dir, n) for n in names})


SQL_PASS_THROUGH = {
    "sql_filter": ("SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00' AND o_orderstatus = 'F'", ["orders"]),
    "sql_join": ("SELECT n.n_name, c.c_custkey, o.o_orderkey FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey WHERE o.o_orderpriority = '1-URGENT'", ["orders", "customer", "nation"]),
    "sql_group": ("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price FROM {lineitem} GROUP BY l_returnflag, l_linestatus", ["lineitem"]),
    "sql_rollup": ("SELECT r.r_name, n.n_name, count(*) AS customers FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey GROUP BY ROLLUP (r.r_name, n.n_name)", ["customer", "nation", "region"]),
    "sql_window": ("SELECT o_custkey, o_orderkey, o_totalprice, rnk FROM (SELECT o_custkey, o_orderkey, o_totalprice, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM {orders}) t WHERE rnk <= 3", ["orders"]),
    "sql_setop": ("SELECT * FROM (SELECT c_custkey FROM {customer} EXCEPT SELECT o_custkey FROM {orders}) UNION ALL SELECT * FROM (SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'O')", ["customer", "orders"]),
}


def _make_sql_query(key):
    text, names = SQL_PASS_THROUGH[key]
    return lambda spark, sf_dir: _sql(spark, sf_dir, text, names)


for _key in SQL_PASS_THROUGH:
    globals()["q_" + _key] = _make_sql_query(_key)
