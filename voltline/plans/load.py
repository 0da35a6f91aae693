"""Load an inbox of report files (or any lines frame) into path-based Parquet tables.

    list files (S1) -> route (F1) -> period (F2/F3) -> window (F4) -> ledger skip (F8)
    -> parse (P1-P10) -> per table: infer or take the target's types -> load_batch (D2) -> ledger mark (K3)

Every step is a DataFrame plan; the driver only holds the candidate path list (as Spark's own file
index does) and the names of the tables and their columns. The lines are split once, whatever the
number of layouts; a table's rows are read from its own partition of the staged split.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline import catalog
from voltline.functions.names import in_period, period_first8, period_strict, route_table
from voltline.operators.infer import apply_types, coerce_first_format, infer_types, infer_types_by_file, is_datetime_name, types_of_first_file
from voltline.operators.ledger import ledger_mark, ledger_skip, read_ledger
from voltline.operators.load import LINEAGE, REPORT_SCHEMA, LoadReport, load_batch, write_rejects
from voltline.operators.report import STATUS_EMPTY, STATUS_OK, parse_report
from voltline.operators.sinks import checksum_of, content_id
from voltline.operators.store import table_schema
from voltline.session import materialize
from voltline.sources.lines import list_files, read_report_lines


# candidate lists up to this size are passed to the reader as paths; beyond, the folder is joined
PATH_LIST_MAX = 100_000
BROADCAST_FILES_MAX = 1_000_000


@dataclass
class LoadOptions:
    start_year: int = catalog.DEFAULT_START_YEAR
    end_year: int = catalog.DEFAULT_END_YEAR
    months: tuple[int, ...] = tuple(range(1, 13))
    grain: str = "file"            # ledger grain, V1 ('month' reproduces the original)
    period_rule: str = "strict"    # F2 everywhere (V3); 'first8' reproduces the loader's own rule
    decode_route: bool = True      # V2: decode %23 before routing
    sections: str = "nearest"      # V6
    extra: str = "drop"            # V5
    strict: bool = False
    inference: str = "batch"       # types of a new table; 'first_file' takes each column's from the first file that fills it
    time_formats: str = "any"      # V7; 'first' reads a DATE/TIME column of a file by its first value's layout alone


def annotate_files(files: DataFrame, opts: LoadOptions) -> DataFrame:
    """Add table_name (lower case, as the ledger keeps it), year, month and the window test to a file listing."""
    period = period_strict("file_name") if opts.period_rule == "strict" else period_first8("file_name")
    return files.select(
        "*",
        F.lower(route_table("file_name", decode=opts.decode_route)).alias("table_name"),
        period["year"].alias("year"),
        period["month"].alias("month"),
    ).withColumn(
        "in_window",
        in_period("year", "month", opts.start_year, opts.end_year, opts.months, zero_is_unknown=opts.period_rule == "first8"),
    )


def plan_candidates(files: DataFrame, ledger: DataFrame, opts: LoadOptions) -> DataFrame:
    """Files to load this run: inside the period window and not covered by the ledger."""
    return ledger_skip(annotate_files(files, opts).filter("in_window"), ledger, grain=opts.grain)


def one_format(rows: DataFrame, names: list[str]) -> DataFrame:
    """P9 with one layout per file and column, for the DATE/TIME columns that hold no numbers in a file."""
    times = [c for c in names if is_datetime_name(c)]
    numbers = infer_types(rows, times)
    times = [c for c in times if numbers[c].simpleString() == "timestamp_ntz"]
    return coerce_first_format(rows, times, LINEAGE) if times else rows


def load_lines(
    spark: SparkSession,
    lines: DataFrame,
    routes: DataFrame,
    warehouse: str,
    ledger_path: str | None = None,
    opts: LoadOptions | None = None,
    declared: dict | None = None,
    batch: str | None = None,
) -> tuple[DataFrame, list[LoadReport]]:
    """Parse a lines frame and merge it into ``warehouse/<TABLE>``; returns (file status frame, reports).

    ``routes`` maps each source_file to table_name / year / month (see ``annotate_files``).
    ``declared`` maps upper-case table names to a StructType used instead of inference (V8).
    ``batch`` names the load, so that a replay replaces its rejects; by default the names, sizes and times of its files do.
    """
    opts = opts or LoadOptions()
    parsed = parse_report(lines, sections=opts.sections)
    # one status row per file that was asked for: a file without a tagged line has no lines in the parse
    named = routes.select("source_file", F.substring_index("source_file", "/", -1).alias("_name"), "table_name", "year", "month")
    found = parsed.file_status().join(named, "source_file", "full")
    status = materialize(
        found.withColumn("file_name", F.coalesce("file_name", "_name")).withColumn("status", F.coalesce("status", F.lit(STATUS_EMPTY)))
        .fillna(0, ["header_lines", "data_lines", "rows"]).drop("_name"),
        "file-status",
    )
    if batch is None:
        told = [c for c in ("source_file", "size", "modified") if c in routes.columns]
        batch = content_id(*routes.agg(F.count(F.lit(1)), checksum_of([F.col(c) for c in told])).first())
    staged = parsed.stage(routes)
    write_rejects(warehouse, staged.orphan_lines(), "lines without a header", batch)
    reports: list[LoadReport] = []
    declared = declared or {}
    for table in sorted(staged.columns):
        model = catalog.table_model(table, declared.get(table.upper()))
        path = f"{warehouse.rstrip('/')}/{model.name}"
        rows = staged.rows(table)
        names = staged.columns[table]
        if opts.time_formats == "first":
            rows = one_format(rows, names)
        if table_schema(spark, path) is None and model.schema is None:
            texts = [c for c in names if rows.schema[c].dataType.simpleString() == "string"]
            if opts.inference == "batch":
                rows = apply_types(rows, infer_types(rows, texts))
            else:  # the table takes the first file's types; what does not fit them is a reject
                types = types_of_first_file(infer_types_by_file(rows, texts))
                model = catalog.table_model(table, T.StructType([T.StructField(c, types.get(c, rows.schema[c].dataType)) for c in names]))
        reports.append(load_batch(spark, rows, path, model, extra=opts.extra, strict=opts.strict, warehouse=warehouse, batch_id=batch))
    if ledger_path:
        loaded = status.filter(F.col("status") == STATUS_OK).select("table_name", "year", "month", "source_file")
        counts = [r.loaded_by_file for r in reports if r.loaded_by_file is not None]
        by_file = reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], "source_file string, rows_loaded bigint")
        loaded = loaded.join(by_file, "source_file", "left").withColumn("rows_loaded", F.coalesce("rows_loaded", F.lit(0).cast("bigint")))
        if "size" in routes.columns:
            loaded = loaded.join(routes.select("source_file", "size", "modified"), "source_file", "left")
        ledger_mark(spark, ledger_path, loaded)
    return status, reports


def load_inbox(
    spark: SparkSession,
    inbox: str,
    warehouse: str,
    ledger_path: str,
    opts: LoadOptions | None = None,
) -> tuple[DataFrame, DataFrame]:
    """G7 as one call: returns (file status frame, per-table report frame)."""
    opts = opts or LoadOptions()
    files = list_files(spark, inbox, "*.[cC][sS][vV]")
    candidates, n = materialize(plan_candidates(files, read_ledger(spark, ledger_path), opts), "candidates", with_count=True)
    if n == 0:
        empty = spark.createDataFrame([], REPORT_SCHEMA)
        return candidates.limit(0), empty
    if n <= PATH_LIST_MAX:
        # a bounded list of new files: hand it to the reader, which then lists nothing else
        paths = [r["source_file"] for r in candidates.select("source_file").collect()]
        lines = read_report_lines(spark, paths, recursive=False)
    else:
        # very many files: read the folder, keep the candidates by a join (no path list on the driver)
        keep = candidates.select("source_file")
        lines = read_report_lines(spark, inbox).join(
            F.broadcast(keep) if n <= BROADCAST_FILES_MAX else keep, "source_file", "left_semi"
        )
    status, reports = load_lines(spark, lines, candidates, warehouse, ledger_path, opts)
    return status, spark.createDataFrame([r.as_row() for r in reports], REPORT_SCHEMA)
