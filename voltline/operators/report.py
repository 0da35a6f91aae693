"""Report parsing: lines frame -> header sections, file status, and per-layout row frames.

Passes over the lines (each one a distributed scan; nothing per file is collected):

1. header lines with their position; the next header of a file bounds each section (a window over
   header lines only); written once, it is small; its distinct headers, analysed by tasks, are the
   layout registry;
2. every D line left-joined to its section -> per-section width statistics and per-file line
   counts -> file status;
3. ``stage``: D lines of the files that passed are split once into an array of fields and written by
   target table; ``StagedReport.rows`` reads one table's rows of all its layouts in one scan, each value
   picked by the position that the registry gives its column. (``strings`` reads a single layout instead.)

The registry is a DataFrame keyed by the header's hash, however many layouts there are; a header that can't be
used fails the files that have it. What comes to the driver are the names of the tables and of their columns.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltline import catalog
from voltline.session import materialize, scratch_dir, ship_package
from voltline.functions.text import drop_invalid_utf8, field_count, null_if_token, strip_right

# section tables with at most this many rows are broadcast to the line scans
BROADCAST_SECTIONS_MAX = 200_000

# headers up to this number are analysed on the driver, more by tasks; the registry is the same
LOCAL_LAYOUTS = 100

STATUS_OK = "ok"
STATUS_EMPTY = "no_header_or_data"
STATUS_BAD_HEADER = "bad_header"
STATUS_WIDTH = "width_mismatch"
STATUS_TOO_WIDE = "row_too_wide"
_STATUS_RANK = {STATUS_EMPTY: 1, STATUS_BAD_HEADER: 2, STATUS_WIDTH: 3, STATUS_TOO_WIDE: 4, STATUS_OK: 9}


@dataclass(frozen=True)
class Layout:
    """One distinct header line and what it means for the data lines under it; ``layout_id`` is the header's hash."""

    layout_id: int
    header: str
    width: int
    start_col: int
    names: tuple[str, ...] = field(default=())
    problem: str | None = None

    @property
    def ok(self) -> bool:
        return self.problem is None


def analyse_header(layout_id: int, header: str) -> Layout:
    """P5 + P10 on one header line (runs on distinct headers only).

    Fields are split with CSV quoting, NULL markers read as missing. After the leading ``I`` the first
    field whose trimmed text is all digits ends the prefix; the payload names follow it. A missing
    name or a duplicate name makes the layout unusable.
    """
    fields = next(csv.reader([header], quotechar='"', doublequote=True))
    values = [None if f in catalog.NULL_TOKENS else f for f in fields]
    width = len(values)
    start_col = 1
    for i, h in enumerate(values[1:]):
        if h is None:
            return Layout(layout_id, header, width, start_col, (), "missing name before the version field")
        if h.strip().isdigit():
            start_col = i + 2
            break
    names = values[start_col:]
    if any(n is None for n in names):
        return Layout(layout_id, header, width, start_col, (), "missing column name")
    if len({n.upper() for n in names}) != len(names):  # a table cannot hold names that differ in case only
        return Layout(layout_id, header, width, start_col, tuple(names), "duplicate column name")
    if any(n.startswith("_") and n in ("_source_file", "_block_start", "_line_id") for n in names):
        return Layout(layout_id, header, width, start_col, tuple(names), "name of a lineage column")
    if not names:
        return Layout(layout_id, header, width, start_col, (), "no payload columns")
    return Layout(layout_id, header, width, start_col, tuple(names), None)


REGISTRY_SCHEMA = "layout_id bigint, header string, width int, start_col int, names array<string>, problem string"


def layout_registry(headers: DataFrame) -> DataFrame:
    """P5 + P10 for a frame of distinct header lines (``header``): one row each, keyed by the header's 64-bit hash."""
    ship_package(headers.sparkSession)
    types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string()]
    names = [c.split()[0] for c in REGISTRY_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [analyse_header(i, h) for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [(x.layout_id, x.header, x.width, x.start_col, list(x.names), x.problem) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return headers.select(F.xxhash64("header").alias("layout_id"), "header").mapInArrow(run, REGISTRY_SCHEMA)


def local_registry(spark: SparkSession, headers: list[str]) -> DataFrame:
    """``layout_registry`` of a few headers that are at hand."""
    found = [analyse_header(0, h) for h in headers]
    rows = [(x.header, x.width, x.start_col, list(x.names), x.problem) for x in found]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA.split(", ", 1)[1]).select(F.xxhash64("header").alias("layout_id"), "*")


def tag_lines(lines: DataFrame) -> DataFrame:
    """P1 + P2: decode, tag 'I'/'D' by exact prefix (no trim, case-sensitive), strip the right end."""
    decoded = lines.select("source_file", "file_name", "block_start", "line_id", drop_invalid_utf8("value").alias("value"))
    v = F.col("value")
    tag = F.when(v.startswith(catalog.HEADER_TAG), F.lit("I")).when(v.startswith(catalog.DATA_TAG), F.lit("D"))
    return decoded.select("source_file", "file_name", "block_start", "line_id", tag.alias("tag"), strip_right(v).alias("value"))


def _pos(block: str, line: str) -> Column:
    return F.struct(F.col(block).alias("b"), F.col(line).alias("l"))


class ParsedReport:
    """Result of ``parse_report``: sections with status and layout, plus per-layout row frames."""

    def __init__(self, tagged: DataFrame, files: DataFrame, sections: DataFrame, registry: DataFrame, sections_mode: str,
                 n_sections: int, n_layouts: int):
        self.n_sections = n_sections  # rows of the section table: decides broadcast vs shuffle join
        self.n_layouts = n_layouts
        self.tagged = tagged
        self.files = files
        self.sections = sections
        self.registry = registry
        self.sections_mode = sections_mode

    @cached_property
    def layouts(self) -> list[Layout]:
        """The registry as a list in header order, for callers that know their layouts to be few (``stage`` needs none of it)."""
        rows = self.registry.orderBy("header").collect()
        return [Layout(r["layout_id"], r["header"], r["width"], r["start_col"], tuple(r["names"]), r["problem"]) for r in rows]

    # -- joins of D lines to sections --------------------------------------------------------
    def _data_with_sections(self, sections: DataFrame, how: str = "inner") -> DataFrame:
        data = self.tagged.filter(F.col("tag") == "D").select(
            "source_file", "file_name", "block_start", "line_id", "value", _pos("block_start", "line_id").alias("pos")
        )
        s = sections.withColumnRenamed("source_file", "s_file")
        if self.n_sections <= BROADCAST_SECTIONS_MAX:
            s = F.broadcast(s)
        cond = data["source_file"] == s["s_file"]
        if self.sections_mode == "nearest":
            cond = cond & (data["pos"] > s["h_pos"]) & (s["n_pos"].isNull() | (data["pos"] < s["n_pos"]))
        return data.join(s, cond, how).drop("s_file")

    def orphan_lines(self) -> DataFrame:
        """Data lines that belong to no header (before the first of their file, or in a file without one)."""
        rows = self._data_with_sections(self.sections.select("source_file", "h_pos", "n_pos"), how="left").filter(F.col("h_pos").isNull())
        return rows.select("source_file", "block_start", "line_id", F.lit("no header before the line").alias("reason"), F.col("value").alias("row"))

    def file_status(self) -> DataFrame:
        """One row per file: status, header/data line counts, rows that parse."""
        sec = self.sections.groupBy("source_file").agg(
            F.min("status_rank").alias("rank"), F.sum("rows").cast("bigint").alias("rows")
        )
        ranks = F.create_map(*[x for k, v in _STATUS_RANK.items() for x in (F.lit(v), F.lit(k))])
        joined = self.files.join(sec, "source_file", "left")
        empty = (F.col("header_lines") == 0) | (F.col("data_lines") == 0) | F.col("rank").isNull()
        status = F.when(empty, F.lit(STATUS_EMPTY)).otherwise(ranks[F.col("rank")])
        return joined.select(
            "source_file",
            "file_name",
            status.alias("status"),
            "header_lines",
            "data_lines",
            F.when(status == STATUS_OK, F.coalesce("rows", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("rows"),
        )

    def strings(self, layout: Layout | int, lineage: bool = True) -> DataFrame:
        """All-string rows of one layout, from files whose status is ok; NULL markers are NULL."""
        lay = layout if isinstance(layout, Layout) else self.layouts[layout]
        secs = self.sections.filter((F.col("layout_id") == lay.layout_id) & F.col("file_ok"))
        rows = self._data_with_sections(secs.select("source_file", "h_pos", "n_pos"))
        schema = ", ".join(f"c{i} string" for i in range(lay.width))
        # the split is a generator output: filters on values derived from the fields cannot be pushed
        # below it, so each line is parsed exactly once whatever the consumers do; only lines that need it meet the CSV reader
        by_csv = F.col("value").contains('"') | F.col("value").contains("\n")
        read = F.when(by_csv, F.from_csv("value", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})).alias("_read")
        cut = F.when(~by_csv, F.split("value", ",")).alias("_cut")
        parsed = rows.select("source_file", "block_start", "line_id", F.inline(F.array(F.struct(read, cut))))
        at = lambda i: F.when(F.col("_cut").isNotNull(), F.get("_cut", F.lit(i))).otherwise(F.col(f"_read.c{i}"))
        named = [null_if_token(at(lay.start_col + j)).alias(name) for j, name in enumerate(lay.names)]
        keep = [F.col("source_file").alias("_source_file"), F.col("block_start").alias("_block_start"), F.col("line_id").alias("_line_id")] if lineage else []
        return parsed.select(*keep, *named)


    def stage(self, routes: DataFrame) -> StagedReport:
        """Split every D line once and write the rows by target table.

        ``routes`` gives each ``source_file`` its ``table_name``. Kept are the rows of files whose status is ok, and
        the lines without a header (whole, under ``ORPHANS``); files without a route give none. A task writes to the
        few tables of its files, so nothing is shuffled.
        """
        spark = self.tagged.sparkSession
        widest = self.registry.agg(F.coalesce(F.max("width"), F.lit(1))).first()[0]
        rows = self._data_with_sections(self.sections.select("source_file", "h_pos", "n_pos", "layout_id", "file_ok"), how="left")
        named = routes.select(F.col("source_file").alias("r_file"), F.lower("table_name").alias("route"))
        named = F.broadcast(named) if self.n_sections <= BROADCAST_SECTIONS_MAX else named
        rows = rows.join(named, F.col("source_file") == F.col("r_file"), "left")
        orphan = F.col("h_pos").isNull()
        kept = rows.filter(orphan | (F.col("file_ok") & F.col("route").isNotNull()))
        # the split is a generator output, so that no filter or projection behind it runs it again
        split = kept.select(
            "source_file", "block_start", "line_id", "layout_id", "route", F.when(orphan, F.col("value")).alias("line"),
            F.when(orphan, F.lit(ORPHANS)).otherwise(F.col("route")).alias("_table"),
            F.explode(F.array(F.when(~orphan, split_fields("value", widest)))).alias("fields"),
        )
        path = scratch_dir(spark, "report-rows")
        split.write.partitionBy("_table").parquet(path)
        schema = "source_file string, block_start bigint, line_id bigint, layout_id bigint, route string, line string, fields array<string>, _table string"
        staged = spark.read.schema(schema).parquet(path)
        # every table's columns: in the order of the headers, then of the fields; names that differ in case only are one
        used = self.sections.filter("file_ok").join(routes.select("source_file", F.lower("table_name").alias("route")), "source_file").select("route", "layout_id").distinct()
        fields = used.join(self.registry.filter(F.col("problem").isNull()), "layout_id").select("route", "header", F.posexplode("names").alias("at", "name"))
        firsts = fields.groupBy("route", F.upper("name").alias("key")).agg(F.min(F.struct("header", "at", "name")).alias("first"))
        columns: dict[str, list[str]] = {}
        for r in firsts.orderBy("route", "first.header", "first.at").collect():
            columns.setdefault(r["route"], []).append(r["first"]["name"])
        return StagedReport(staged, self.registry, self.n_layouts, columns)


#: Partition of the staged rows that holds lines without a header.
ORPHANS = "_orphans"
#: Registry copies sent to every task stay below this many bytes (four for each column of each layout).
BROADCAST_POSITIONS_BYTES = 64 << 20


def split_fields(value: str, widest: int) -> Column:
    """The fields of a line as an array. Lines with a quote go through the CSV reader, ``widest`` fields at most."""
    schema = ", ".join(f"c{i} string" for i in range(widest))
    quoted_line = F.transform(F.array(F.from_csv(value, schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})),
                              lambda s: F.array(*[s[f"c{i}"] for i in range(widest)]))
    return F.when(F.col(value).contains('"'), F.get(quoted_line, F.lit(0))).otherwise(F.split(F.col(value), ","))


@dataclass
class StagedReport:
    """Rows of a parsed report split into fields and lying by table; ``columns``: names of each table's columns in order."""

    staged: DataFrame
    registry: DataFrame
    n_layouts: int
    columns: dict[str, list[str]]

    def rows(self, table: str) -> DataFrame:
        """All-string rows of one table, all layouts in one scan of its partition; columns a layout lacks are NULL."""
        names = self.columns[table]
        known = F.transform("names", lambda n: F.upper(n))
        at = F.array(*[F.array_position(known, F.lit(n.upper())) for n in names])
        picks = self.registry.filter(F.col("problem").isNull()).select(
            "layout_id", F.transform(at, lambda p: F.when(p > 0, (F.col("start_col") + p - 1).cast("int"))).alias("picks"))
        if 4 * self.n_layouts * len(names) <= BROADCAST_POSITIONS_BYTES:
            picks = F.broadcast(picks)
        rows = self.staged.filter(F.col("_table") == table).join(picks, "layout_id")
        values = [null_if_token(F.get("fields", F.get("picks", F.lit(j)))).alias(n) for j, n in enumerate(names)]
        return rows.select(F.col("source_file").alias("_source_file"), F.col("block_start").alias("_block_start"), F.col("line_id").alias("_line_id"), *values)

    def orphan_lines(self) -> DataFrame:
        """Data lines that belong to no header (before the first of their file, or in a file without one)."""
        rows = self.staged.filter(F.col("_table") == ORPHANS)
        return rows.select("source_file", "block_start", "line_id", F.upper("route").alias("table_name"), F.lit("no header before the line").alias("reason"), F.col("line").alias("row"))


def section_widths(data: DataFrame) -> DataFrame:
    """(source_file, file_name, h_pos, rows, first_width, max_width) of the D lines of each section.

    Lines are added up by split first, where a number orders them, so that Spark does it in hash tables: ordered by a
    struct, the lines themselves would be sorted. A missing position comes first, as in ``pos``.
    """
    at = lambda c: F.coalesce(F.col(c), F.lit(-(1 << 63)))
    lines = data.select("source_file", "file_name", "h_pos", at("block_start").alias("b"), at("line_id").alias("l"), field_count("value").alias("width_"))
    by_split = lines.groupBy("source_file", "file_name", "h_pos", "b").agg(F.count("*").alias("rows"), F.min_by("width_", "l").alias("first_width"), F.max("width_").alias("max_width"))
    return by_split.groupBy("source_file", "file_name", "h_pos").agg(F.sum("rows").alias("rows"), F.min_by("first_width", "b").alias("first_width"), F.max("max_width").alias("max_width"))


def parse_report(lines: DataFrame, sections: str = "nearest") -> ParsedReport:
    """Parse a lines frame.

    ``sections='nearest'`` (default, V6): each D line belongs to the nearest preceding I line of its file.
    ``sections='last'``: the last I line of a file names every D line of it (original behaviour).
    """
    if sections not in ("nearest", "last"):
        raise ValueError("sections must be 'nearest' or 'last'")
    tagged = tag_lines(lines)

    # pass 1: header lines with their position -> one row per section (small, written once)
    heads = tagged.filter(F.col("tag") == "I").select(
        "source_file", "file_name", _pos("block_start", "line_id").alias("h_pos"), F.col("value").alias("header")
    )
    if sections == "last":
        # max_by is combined map-side: one row per file whatever the number of header lines
        sec = heads.groupBy("source_file").agg(
            F.max("h_pos").alias("h_pos"), F.max_by("header", "h_pos").alias("header"), F.count("*").alias("header_lines"),
            F.first("file_name").alias("file_name"),
        ).select("source_file", "file_name", "h_pos", F.lit(None).cast("struct<b:bigint,l:bigint>").alias("n_pos"), "header", "header_lines")
    else:
        # header lines only (a few per file); the window buffer spills if a file has very many
        w = Window.partitionBy("source_file").orderBy("h_pos")
        sec = heads.select(
            "source_file", "file_name", "h_pos", F.lead("h_pos").over(w).alias("n_pos"), "header",
            F.count("*").over(Window.partitionBy("source_file")).alias("header_lines"),
        )
    sec, n_sections = materialize(sec, "report-heads", with_count=True)

    # layouts: one row per distinct header, analysed where they lie; a few are no job of their own
    headers = sec.select("header").distinct()
    few = [r["header"] for r in headers.limit(LOCAL_LAYOUTS + 1).collect()]
    if len(few) <= LOCAL_LAYOUTS:
        registry, n_layouts = local_registry(lines.sparkSession, few), len(few)
    else:
        registry, n_layouts = materialize(layout_registry(headers), "report-layouts", with_count=True)
    keyed = registry.select("layout_id", "header", "width", F.col("problem").isNull().alias("layout_ok"))
    sec = sec.join(F.broadcast(keyed) if n_layouts <= BROADCAST_SECTIONS_MAX else keyed, "header", "inner")
    parsed = ParsedReport(tagged, None, sec, registry, sections, n_sections, n_layouts)

    # pass 2: every D line, attached to its section when it has one -> width statistics per section,
    # data-line counts per file (lines before any header count as data but belong to no section)
    joined = parsed._data_with_sections(sec.select("source_file", "h_pos", "n_pos"), how="left")
    stats = materialize(section_widths(joined), "report-stats")
    data_counts = stats.groupBy("source_file", "file_name").agg(F.sum("rows").cast("bigint").alias("data_lines"))
    files = sec.select("source_file", "file_name", F.col("header_lines").cast("bigint").alias("header_lines")).distinct() \
        .join(data_counts, ["source_file", "file_name"], "full")
    parsed.files = files.select(
        "source_file", "file_name",
        F.coalesce("header_lines", F.lit(0)).cast("bigint").alias("header_lines"),
        F.coalesce("data_lines", F.lit(0)).cast("bigint").alias("data_lines"),
    )
    sec = sec.join(stats.filter(F.col("h_pos").isNotNull()).drop("file_name"), ["source_file", "h_pos"], "left")
    rank = (
        F.when(F.col("rows").isNull(), F.lit(_STATUS_RANK[STATUS_EMPTY]))
        .when(~F.col("layout_ok"), F.lit(_STATUS_RANK[STATUS_BAD_HEADER]))
        .when(F.col("first_width") != F.col("width"), F.lit(_STATUS_RANK[STATUS_WIDTH]))
        .when(F.col("max_width") > F.col("first_width"), F.lit(_STATUS_RANK[STATUS_TOO_WIDE]))
        .otherwise(F.lit(_STATUS_RANK[STATUS_OK]))
    )
    # a section without D lines does not fail a file that has data elsewhere
    rank = F.when(F.col("rows").isNull(), F.lit(None)).otherwise(rank)
    sec = sec.withColumn("status_rank", rank).withColumn("rows", F.coalesce("rows", F.lit(0)))
    # a file loads only when every section of it that has rows is ok (and it has both kinds of lines)
    file_rank = sec.groupBy("source_file").agg(F.min("status_rank").alias("file_rank"))
    ok_files = parsed.files.filter((F.col("header_lines") > 0) & (F.col("data_lines") > 0)).select("source_file")
    file_rank = file_rank.join(ok_files, "source_file", "left_semi")
    sec = sec.join(file_rank, "source_file", "left").withColumn(
        "file_ok", F.coalesce(F.col("file_rank") == _STATUS_RANK[STATUS_OK], F.lit(False))
    ).drop("file_rank")
    parsed.sections = materialize(sec, "report-sections")
    return parsed
