"""G2-G6 planning of downloads and extraction, as DataFrame plans.

Fetching over HTTP is not built: the plans end in a *manifest* (url, file_name, table, period) that a
downloader of the user's choice consumes. Everything before it - month grid, completeness checks,
listing-page links, name matching, ledger and already-local skips - is here.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline import catalog
from voltline.functions.names import in_period, period_first8, period_strict
from voltline.operators.ledger import ledger_months
from voltline.sources.archives import expand_archives, read_archives
from voltline.sources.links import extract_links, page_links, resolve_url

SOURCES = ("mmsdm", "archive", "current")


def check_source(source: str) -> str:
    """Normalise the source name; an unknown one is an error."""
    s = str(source).strip().lower()
    if s not in SOURCES:
        raise ValueError(f"no such source: {source!r}; the sources are {SOURCES}")
    return s


def _tables_array(tables: Sequence[str]) -> Column:
    return F.array(*[F.lit(t.upper()) for t in tables])


def period_grid(spark: SparkSession, start_year: int | Column, end_year: int | Column, months: Sequence[int] | Column,
                base_url: str, current_year: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """F12 + F13: (year, month, url), years from end to start, months descending.

    Bounds may be Columns over ``source`` (a one-row frame), so the grid can be derived from data.
    ``current_year`` clamps the end year: this year when not given (give it where a run must be repeatable).
    """
    base = source if source is not None else spark.range(1).select()
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    end = lit(end_year)
    end = F.least(end, F.lit(current_year) if current_year is not None else F.year(F.current_date()))
    months_col = months if isinstance(months, Column) else F.array(*[F.lit(m) for m in months])
    start = lit(start_year)
    years = F.when(end >= start, F.sequence(end, start, F.lit(-1))).otherwise(F.array().cast("array<int>"))
    grid = base.select(F.explode(years).alias("year"), F.sort_array(months_col, asc=False).alias("ms"))
    grid = grid.select("year", F.explode("ms").alias("month"))
    return grid.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        month_url(base_url, F.col("year"), F.col("month")).alias("url"),
    )


def month_url(base_url: str, year: Column, month: Column) -> Column:
    """F13 for Columns."""
    return F.concat(F.lit(base_url), year.cast("string"), F.lit("/MMSDM_"), year.cast("string"), F.lit("_"),
                    F.lpad(month.cast("string"), 2, "0"), F.lit("/MMSDM_Historical_Data_SQLLoader/DATA/"))


def match_table(file_name: Column, tables: Sequence[str]) -> Column:
    """first wanted table T whose name pattern occurs in the (upper-cased) file name, else NULL.

    Patterns: ``PUBLIC_DVD_{T}_``, ``PUBLIC_ARCHIVE#{T}#``, ``PUBLIC_ARCHIVE%23{T}%23``. The table list is
    configuration (a handful of names): one pattern holds all of it, in its order. A name with several
    patterns, which is rare, takes the table that the list has first.
    """
    names = "|".join(re.escape(t.upper()) for t in tables)
    dvd, mark, coded = (re.escape(x) for x in (catalog.DVD_PREFIX, catalog.ARCHIVE_MARKER, catalog.ARCHIVE_MARKER_ENCODED))
    prefix = f"(?:{dvd}|{mark}|{coded})"
    found = F.regexp_extract_all(file_name, F.lit(f"{dvd}(?:{names})(?=_)|{mark}(?:{names})(?=#)|{coded}(?:{names})(?=%23)"), F.lit(0))
    only = F.regexp_replace(F.get(found, F.lit(0)), f"^{prefix}", "")
    several = F.transform(found, lambda x: F.regexp_replace(x, f"^{prefix}", ""))
    first = F.get(F.filter(_tables_array(tables), lambda t: F.array_contains(several, t)), F.lit(0))
    return F.when(F.size(found) <= 1, only).otherwise(first) if tables else F.lit(None).cast("string")


def include_filter(file_name: Column, patterns: Column | Sequence[str]) -> Column:
    """keep when the pattern list is empty or one upper-cased pattern occurs in the name."""
    pats = patterns if isinstance(patterns, Column) else F.array(*[F.lit(p) for p in patterns]).cast("array<string>")
    return (F.size(pats) == 0) | F.exists(pats, lambda p: file_name.contains(F.upper(p)))


def local_month_tables(local_files: DataFrame, tables: Sequence[str]) -> DataFrame:
    """(table, year, month) covered by local archives.

    A local ``.ZIP`` covers (T, Y, M) when its upper-cased name starts with one of T's prefixes and
    contains ``YYYYMM`` anywhere; every 6-digit window of the name is a candidate month.
    """
    name = F.upper(F.col("file_name"))
    prefixes = lambda t: [F.concat(F.lit(catalog.DVD_PREFIX), t, F.lit("_")),
                          F.concat(F.lit(catalog.ARCHIVE_MARKER_ENCODED), t, F.lit("%23")),
                          F.concat(F.lit(catalog.ARCHIVE_MARKER), t, F.lit("#"))]
    tabs = F.filter(_tables_array(tables), lambda t: name.startswith(prefixes(t)[0]) | name.startswith(prefixes(t)[1]) | name.startswith(prefixes(t)[2]))
    windows = F.regexp_extract_all(name, F.lit(r"(?=(\d{6}))"), 1)
    return (
        local_files.filter(name.endswith(".ZIP"))
        .select(F.explode(tabs).alias("table_name"), F.explode(F.array_distinct(windows)).alias("yyyymm"))
        .select(
            F.lower("table_name").alias("table_name"),
            F.substring("yyyymm", 1, 4).cast("int").alias("year"),
            F.substring("yyyymm", 5, 2).cast("int").alias("month"),
        )
        .filter(F.col("month").between(1, 12))
        .distinct()
    )


def period_completeness(grid: DataFrame, ledger: DataFrame, local: DataFrame, tables: Sequence[str]) -> DataFrame:
    """per grid month, how many wanted tables are loaded or local, and whether all are (-> skip).

    The covered set is (table, year, month) rows; counting distinct wanted tables per month and
    comparing with the size of the configured list replaces the per-table loop.
    """
    wanted = [t.lower() for t in tables]
    covered = (
        ledger_months(ledger).select("table_name", "year", "month")
        .unionByName(local.select("table_name", "year", "month"))
        .filter(F.col("table_name").isin(*wanted))
        .groupBy("year", "month")
        .agg(F.count_distinct("table_name").alias("covered_tables"))
    )
    return grid.join(covered, ["year", "month"], "left").select(
        "year", "month", grid.columns[2] if len(grid.columns) > 2 else F.lit(None).alias("url"),
        F.coalesce("covered_tables", F.lit(0)).cast("bigint").alias("covered_tables"),
        (F.coalesce("covered_tables", F.lit(0)) == len(set(wanted))).alias("complete"),
    )


def feed_completeness(links: DataFrame, ledger: DataFrame, all_tables: Sequence[str]) -> DataFrame:
    """per link of a feed, whether every table of the feed (or, when it lists none, every configured
    table) is loaded for the link's period; a link of unknown period is never complete.

    ``links`` has file_name, feed_tables (array<string>), year, month.
    """
    fallback = F.array(*[F.lit(t.lower()) for t in all_tables])
    tables = F.when(F.size("feed_tables") > 0, F.transform("feed_tables", lambda t: F.lower(t))).otherwise(fallback)
    exploded = links.select("*", F.explode(F.array_distinct(tables)).alias("table_name"))
    months = ledger_months(ledger).withColumn("hit", F.lit(True))
    per = exploded.join(months, ["table_name", "year", "month"], "left")
    keys = [c for c in links.columns if c != "feed_tables"]
    loaded = per.groupBy(*keys).agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("all_loaded"))
    known = F.col("year").isNotNull() & F.col("month").isNotNull()
    return loaded.select(*keys, (F.col("all_loaded") & known).alias("complete"))


# The month in the url of a historical listing page.
_PAGE_MONTH = r"MMSDM_(\d{4})_(\d{2})/"


def month_pages(spark: SparkSession, tables: Sequence[str], ledger: DataFrame, local_files: DataFrame, base_url: str, start_year: int | Column, end_year: int | Column,
                months: Sequence[int] | Column, current_year: int | None = None, source: DataFrame | None = None) -> DataFrame:
    """G3 page stage: F12 grid -> F13 urls -> F9: the (year, month, url) of listing pages that are still to be read."""
    grid = period_grid(spark, start_year, end_year, months, base_url, current_year, source)
    local = local_month_tables(local_files.select(F.upper("file_name").alias("file_name")).distinct(), tables)
    complete = period_completeness(grid, ledger, local, tables).filter("complete").select("year", "month")
    return grid.join(complete, ["year", "month"], "left_anti")


def link_manifest(pages: DataFrame, tables: Sequence[str], ledger: DataFrame, local_files: DataFrame,
                  suffix: str = ".zip") -> DataFrame:
    """G3 link stage: F5 name match -> F8 ledger skip -> F11 already-local skip.

    The ledger is asked for the month of the page, read from its url; a page of unknown month falls back to the
    link's own period. ``year`` and ``month`` of the result are the link's.
    ``local_files`` has ``file_name`` (the on-disk, un-decoded last URL segment).
    """
    # the match is a generator: links of no wanted table end here, only the others are resolved and dated
    hit = match_table(F.col("file_name"), tables)
    links = page_links(pages, suffix=suffix).select("*", F.explode(F.when(hit.isNotNull(), F.array(F.lower(hit)))).alias("table_name"))
    period = period_strict(F.col("file_name"))
    matched = links.select(
        "page_id", "position", "href", resolve_url("page_url", "href").alias("url"), "file_name", "table_name",
        period["year"].alias("year"), period["month"].alias("month"),
        F.substring_index("href", "/", -1).alias("local_name"),
        *[F.regexp_extract("page_url", _PAGE_MONTH, i).try_cast("int").alias(f"page_{k}") for i, k in ((1, "year"), (2, "month"))],
    )
    asked = matched.select("*", *[F.when(F.col("page_year").isNull(), F.col(k)).otherwise(F.col(f"page_{k}")).alias(f"_{k}") for k in ("year", "month")])
    done = ledger_months(ledger).select("table_name", F.col("year").alias("_year"), F.col("month").alias("_month"))
    fresh = asked.join(done, ["table_name", "_year", "_month"], "left_anti").drop("_year", "_month", "page_year", "page_month")
    return fresh.join(local_files.select(F.col("file_name").alias("local_name")).distinct(), "local_name", "left_anti")


def archive_links(links: DataFrame, start_year: int, end_year: int, months: Sequence[int]) -> DataFrame:
    """G4 stages F7 (already applied by the caller's include filter) -> F2 -> F4 on a link frame."""
    period = period_strict(F.col("file_name"))
    return links.withColumn("year", period["year"]).withColumn("month", period["month"]).filter(
        in_period("year", "month", start_year, end_year, months)
    )


FEED_SCHEMA = "name string, url string, tables array<string>, include_patterns array<string>"


def feeds_frame(spark: SparkSession, feeds: Sequence[dict] | None, root_url: str | None,
                tables: Sequence[str] = catalog.DEFAULT_WANTED_TABLES) -> DataFrame:
    """Feed configuration as a DataFrame; F14: no feeds but a root URL -> one feed with all tables."""
    upper = lambda names: [str(x).upper() for x in names]
    rows = [(f.get("name", "feed"), f["url"], upper(f.get("tables", ())), upper(f.get("include_patterns", ()))) for f in feeds or () if f.get("url")]
    if not rows and root_url:
        return spark.createDataFrame([("root", root_url, [t.upper() for t in tables], [])], FEED_SCHEMA)
    return spark.createDataFrame(rows, FEED_SCHEMA)


def feed_links(pages: DataFrame, feeds: DataFrame, suffix: str = ".zip") -> DataFrame:
    """S6 + F7 for feed listing pages: ``pages`` (page_id, url, html) whose url is a feed url."""
    links = extract_links(pages, suffix=suffix).join(
        pages.select("page_id", F.col("url").alias("feed_url")), "page_id"
    )
    f = F.broadcast(feeds.select(F.col("url").alias("feed_url"), F.col("name").alias("feed"),
                                 F.col("tables").alias("feed_tables"), F.col("include_patterns")))
    joined = links.join(f, "feed_url")  # feeds: configuration, a handful of rows
    return joined.filter(include_filter(F.col("file_name"), F.col("include_patterns"))).drop("include_patterns")


def plan_downloads(
    spark: SparkSession,
    source: str,
    pages: DataFrame,
    ledger: DataFrame,
    local_files: DataFrame,
    tables: Sequence[str] = catalog.DEFAULT_WANTED_TABLES,
    feeds: Sequence[dict] | None = None,
    root_url: str | None = None,
    start_year: int = catalog.DEFAULT_START_YEAR,
    end_year: int = catalog.DEFAULT_END_YEAR,
    months: Sequence[int] | Column = catalog.DEFAULT_MONTHS,
    base_url: str | None = None,
    current_year: int | None = None,
    grid_source: DataFrame | None = None,
) -> DataFrame:
    """The download manifest (url, file_name, ...) for one source.

    ``pages`` are the fetched listing pages (page_id, url, html): month pages for ``mmsdm``, feed pages for
    ``archive``/``current``. With ``base_url`` only the month pages that ``month_pages`` still wants are read.
    """
    src = check_source(source)
    local = local_files.select(F.col("file_name").alias("local_name")).distinct()
    if src == "mmsdm":
        # F12 -> F13 -> F9 -> S6 -> F5 -> F8 -> F11
        if base_url is not None:
            wanted = month_pages(spark, tables, ledger, local_files, base_url, start_year, end_year, months, current_year, grid_source)
            pages = pages.join(wanted.select("url"), "url", "left_semi")
        return link_manifest(pages, tables, ledger, local_files)
    fr = feeds_frame(spark, feeds, root_url if src == "current" else None, tables)
    links = feed_links(pages, fr).withColumn("local_name", F.substring_index("href", "/", -1))
    if src == "archive":
        # F7 -> F2 -> F4 -> F10 -> F11
        ranged = archive_links(links, start_year, end_year, months)
        done = feed_completeness(
            ranged.select("file_name", "feed_tables", "year", "month").distinct(), ledger, tables
        ).filter("complete").select("file_name", "year", "month")
        ranged = ranged.join(done, ["file_name", "year", "month"], "left_anti")
        return ranged.join(local, "local_name", "left_anti")
    # G5 current: F14 -> S6 -> F7 -> F11 (no period or ledger test)
    return links.join(local, "local_name", "left_anti")


def extract_window(start_year: int, end_year: int, months: Sequence[int]) -> Column:
    """Whether an archive's ``file_name`` is inside the period window (first-8 rule, 0 = unknown)."""
    p = period_first8(F.col("file_name"))
    return in_period(p["year"], p["month"], start_year, end_year, months, zero_is_unknown=True)


def extract_plan(archives: DataFrame, start_year: int, end_year: int, months: Sequence[int]) -> DataFrame:
    """G6 over a frame of archives: those inside the window are expanded. ``extract_folder`` prunes before content is read."""
    return expand_archives(archives.filter(extract_window(start_year, end_year, months)))


def extract_folder(spark: SparkSession, folder: str, start_year: int, end_year: int, months: Sequence[int]) -> DataFrame:
    """Members of the archives under ``folder`` inside the window; the others are pruned when the folder is listed."""
    return expand_archives(read_archives(spark, folder, file_filter=extract_window(start_year, end_year, months)))
