"""D2 + K1 + K2 + D3: merge one batch of typed rows into a target Parquet table, insert-only.

    create the table from the batch schema when absent (K1)
    -> align to the target (E1, E2) -> cast (E3, rejects split off)
    -> first-wins dedupe inside the batch (D1) -> drop keys already in the target (J1)
    -> append (K2), with counters for every step (D3)

Rows that cannot be loaded (a value that does not convert, a NULL in a key column: V4, V11) go to the
``_rejects`` table beside the tables, with their file, line and reason, so for every load
``rows_in = rows_loaded + already_present + dup_in_batch + rejected``.

Tables without a primary key are guarded by the ``_source_file`` lineage column instead: rows of a
file that is already in the table are not appended again, so replaying a batch is a no-op (V10).
The deduped batch is written once to the session's shared checkpoint folder (lineage cut: a lost
executor later re-reads it instead of re-running the parse); counters come from ``observe`` on the
same jobs, so counting costs no extra pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.catalog import TableModel
from voltline.functions.text import quoted
from voltline.operators.align import align_schema, cast_to_target
from voltline.operators.dedupe import anti_join_new, dedupe_first
from voltline.operators.store import PERIOD, append, bound_target, create_table, in_periods_of, log_schema, period_column, read_table, table_schema
from voltline.operators.sinks import BATCH, PART, checksum_of, content_id, read_written, write_once
from voltline.session import materialize, path_exists

LINEAGE = ("_source_file", "_block_start", "_line_id")
STORED_LINEAGE = ("_source_file",)


@dataclass
class LoadReport:
    table: str
    rows_in: int = 0
    rejected: int = 0
    dup_in_batch: int = 0
    already_present: int = 0
    rows_loaded: int = 0
    created: bool = False
    added_columns: list[str] = field(default_factory=list)
    dropped_columns: list[str] = field(default_factory=list)
    key_checked: bool = True
    loaded_by_file: DataFrame | None = None  # (source_file, rows_loaded) of this load

    def as_row(self) -> tuple:
        return (self.table, self.rows_in, self.rejected, self.dup_in_batch, self.already_present, self.rows_loaded, self.dropped_columns)


REPORT_SCHEMA = "table_name string, rows_in bigint, rejected bigint, dup_in_batch bigint, already_present bigint, rows_loaded bigint, dropped_columns array<string>"

# The rejects of every load under one warehouse; a leading underscore keeps it out of the table listing.
REJECTS = "_rejects"
REJECT_SCHEMA = "table_name string, source_file string, block_start bigint, line_id bigint, reason string, row string"


def write_rejects(warehouse: str, rows: DataFrame, part: str, batch_id: str) -> int:
    """Put rows among the warehouse's rejects, in place of what ``(part, batch_id)`` had there; returns their number.

    Columns of ``REJECT_SCHEMA`` that ``rows`` lacks are NULL."""
    fields = [c.split() for c in REJECT_SCHEMA.split(", ")]
    out = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in fields])
    return write_once(out, f"{warehouse.rstrip('/')}/{REJECTS}", part, batch_id)


def read_rejects(spark: SparkSession, warehouse: str) -> DataFrame:
    path = f"{warehouse.rstrip('/')}/{REJECTS}"
    return read_written(spark, path, REJECT_SCHEMA).drop(PART, BATCH) if path_exists(path, spark) else spark.createDataFrame([], REJECT_SCHEMA)


def load_batch(
    spark: SparkSession,
    batch: DataFrame,
    table_path: str,
    model: TableModel,
    extra: str = "drop",
    strict: bool = False,
    warehouse: str | None = None,
    batch_id: str | None = None,
) -> LoadReport:
    """Merge ``batch`` (typed, with lineage columns) into the Parquet table at ``table_path``.

    Loading a batch again changes nothing: its rows are found in the table, and its rejects replace those of the
    attempt before, told by ``batch_id`` (a hash of the batch's rows when not given).

    Rejects go to ``warehouse`` (the table's folder when not given); with ``strict`` an unconvertible value or a
    NULL key fails the job instead. ``extra='add'`` keeps columns that the table does not know: they are added to its
    schema log, and older rows read as NULL there.
    """
    report = LoadReport(model.name)
    lineage_in = [c for c in LINEAGE if c in batch.columns]
    data_cols = [c for c in batch.columns if c not in LINEAGE]
    target = table_schema(spark, table_path)
    if target is None:
        # K1: a schema declared in the catalogue wins (V8), else the batch's (inferred) schema
        declared = model.schema.fields if model.schema is not None else None
        fields = list(declared) if declared is not None else [f for f in batch.schema.fields if f.name in data_cols]
        schema = T.StructType(fields + [T.StructField(c, T.StringType(), True) for c in STORED_LINEAGE])
        if period_column(model, schema):
            schema = schema.add(PERIOD, T.IntegerType())
        create_table(spark, table_path, schema)
        target = schema
        report.created = True
    # a table is split by the month of a key time, or not at all
    period = period_column(model, target) if PERIOD in target.fieldNames() else None
    target_data = T.StructType([f for f in target.fields if f.name not in (*LINEAGE, PERIOD)])

    aligned = align_schema(batch, target_data, extra=extra, keep=lineage_in)
    report.added_columns, report.dropped_columns = aligned.added, aligned.dropped
    good, bad = cast_to_target(aligned.frame, target_data, strict=strict)
    key = [k for k in model.primary_key]
    report.key_checked = bool(key) and all(k in data_cols for k in key)
    order = [c for c in LINEAGE if c in good.columns]
    # every row is parsed and cast once, the good and the rejected ones written side by side
    no_key = F.concat_ws(",", *[F.when(quoted(k).isNull(), F.lit(k)) for k in key]) if report.key_checked else F.lit("")
    columns = good.columns
    marked = good.withColumn("_reject_reason", F.when(no_key != "", F.concat(F.lit("null key: "), no_key)))
    as_text = F.to_json(F.struct(*[quoted(c) for c in data_cols if c in bad.columns])) if any(c in bad.columns for c in data_cols) else F.lit(None).cast("string")
    marked = marked.withColumn("_reject_row", F.when(F.col("_reject_reason").isNotNull(), as_text))
    lost = bad.withColumn("_reject_row", as_text).select(
        *[F.lit(None).cast(good.schema[c].dataType).alias(c) if c not in LINEAGE else F.col(c) for c in columns], "_reject_reason", "_reject_row"
    )
    both = marked.unionByName(lost)
    told = Observation("batch-content")
    staged, report.rows_in = materialize(both.observe(told, checksum_of([quoted(c) for c in both.columns]).alias("sum")), "batch", with_count=True)
    batch_id = batch_id or content_id(report.rows_in, told.get["sum"])
    wrong = staged.filter(F.col("_reject_reason").isNotNull())
    if strict and report.key_checked and not wrong.isEmpty():
        raise ValueError(f"{model.name}: rows with a NULL in a key column")
    named = {"_source_file": "source_file", "_block_start": "block_start", "_line_id": "line_id"}
    report.rejected = write_rejects(
        warehouse or table_path.rstrip("/").rsplit("/", 1)[0],
        wrong.select(F.lit(model.name).alias("table_name"), *[F.col(c).alias(named[c]) for c in order], F.col("_reject_reason").alias("reason"), F.col("_reject_row").alias("row")),
        model.name, batch_id,
    )
    rows = staged.filter(F.col("_reject_reason").isNull()).select(*[quoted(c) for c in columns])
    existing = read_table(spark, table_path)
    if report.key_checked:
        # without lineage the least row of a key is its first
        deduped, n_dedup = materialize(dedupe_first(rows, key, order or [c for c in rows.columns if c not in key]), "dedupe", with_count=True)
        report.dup_in_batch = report.rows_in - report.rejected - n_dedup
        known = in_periods_of(existing, deduped, period) if period else existing
        new = anti_join_new(deduped, bound_target(known, deduped, key[0]), key, known_keys=n_dedup)
    else:
        # No key (or key columns missing): replay guard on the lineage column only
        n_dedup = report.rows_in - report.rejected
        new = rows
        if "_source_file" in rows.columns and "_source_file" in existing.columns:
            # the batch's few file names bound and filter the target's; only names that both have come to the anti-join
            files = rows.select("_source_file").distinct()
            seen = bound_target(existing.select("_source_file"), files, "_source_file").join(files, "_source_file", "left_semi").distinct()
            new = rows.join(seen, "_source_file", "left_anti")
    stored = [f.name for f in target.fields if f.name != PERIOD]
    beyond = [c for c in columns if c not in stored and c not in LINEAGE] if extra == "add" else []
    new = new.select(*[quoted(c) if c in new.columns else F.lit(None).cast(target[c].dataType).alias(c) for c in stored], *[quoted(c) for c in beyond])
    # the new rows are written once and appended from there: their counts by file come without the join run again
    new, report.rows_loaded = materialize(new, "new-rows", with_count=True)
    if beyond:  # the log goes first: a column that no file has yet is NULL
        log_schema(spark, table_path, T.StructType([*target.fields, *[T.StructField(c, new.schema[c].dataType) for c in beyond]]))
    if report.rows_loaded:
        append(new, table_path, report.rows_loaded, key[0] if key and key[0] in new.columns else None, period)
    if "_source_file" in new.columns:
        report.loaded_by_file = new.groupBy(F.col("_source_file").alias("source_file")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    report.already_present = n_dedup - report.rows_loaded
    return report
