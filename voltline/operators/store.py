"""Stored tables: Parquet folders with a schema log, split by period where the key holds a time.

    <table>/_schemas/00000001.json       the table's schema as of each version; the last one is its schema
    <table>/_period=202601/part-….parquet  rows whose key time lies in that month (tables without one: no folders)

Readers take the schema from the log: no footer is opened for it, and columns that older files lack are NULL. Equal
keys have equal periods, so a load looks for its keys in the periods of its batch only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.catalog import TableModel
from voltline.functions.text import quoted
from voltline.session import glob_escaped, path_exists

PERIOD = "_period"
_SCHEMAS = "_schemas"
_TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)
#: Periods of a batch that are listed in the filter on the target; of more, the filter is their range.
LISTED_PERIODS = 1_000
#: Rows of a data file that an append aims at.
ROWS_PER_FILE = 2_000_000


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _versions(spark: SparkSession, path: str) -> list[str]:
    files, where = _hadoop(spark, f"{path.rstrip('/')}/{_SCHEMAS}")
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.getPath().getName().endswith(".json")) if files.exists(where) else []


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The last schema of a table's log, None without a log."""
    names = _versions(spark, path)
    if not names:
        return None
    files, where = _hadoop(spark, f"{path.rstrip('/')}/{_SCHEMAS}/{names[-1]}")
    stream = files.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def log_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add a version to the table's log; two writers of one version fail rather than overwrite each other."""
    number = int(_versions(spark, path)[-1].split(".")[0]) + 1 if _versions(spark, path) else 1
    files, where = _hadoop(spark, f"{path.rstrip('/')}/{_SCHEMAS}/{number:08d}.json")
    stream = files.create(where, False)
    try:
        stream.write(bytearray(schema.json(), "utf-8"))
    finally:
        stream.close()


def schema_history(spark: SparkSession, path: str) -> DataFrame:
    """(version, position, column_name, data_type) of every version of a table's schema."""
    rows = spark.read.text(f"{glob_escaped(path.rstrip('/'))}/{_SCHEMAS}/*.json", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("int").alias("version"), "value")
    fields = F.posexplode(F.from_json(F.get_json_object("value", "$.fields"), "array<struct<name string, type string>>")).alias("at", "f")
    # the log has the names of Spark's JSON schemas
    sql_name = F.when(F.col("f.type") == "long", "bigint").when(F.col("f.type") == "integer", "int").when(F.col("f.type") == "short", "smallint").when(F.col("f.type") == "byte", "tinyint").otherwise(F.col("f.type"))
    return rows.select("version", fields).select("version", (F.col("at") + 1).alias("position"), F.col("f.name").alias("column_name"), sql_name.alias("data_type"))


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a path table, None when it does not exist. Tables of other writers have no log: Spark infers theirs."""
    if not path_exists(path, spark):
        return None
    return logged_schema(spark, path) or spark.read.parquet(glob_escaped(path)).schema


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table by its own schema."""
    known = logged_schema(spark, path)
    reader = spark.read if known is None else spark.read.schema(known)
    return reader.parquet(glob_escaped(path))


def period_of(column: str) -> Column:
    """The month of a time as a number (yyyyMM), zone-free."""
    return (F.year(quoted(column)) * 100 + F.month(quoted(column))).cast("int")


def period_column(model: TableModel, schema: T.StructType) -> str | None:
    """The key column that a new table with ``schema`` is split by: the first that holds a time."""
    return next((k for k in model.primary_key if k in schema.fieldNames() and isinstance(schema[k].dataType, _TIMES)), None)


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """K1: an empty table with the given schema (split by ``_period`` if it has that column); fails if it exists."""
    if path_exists(path, spark):
        raise ValueError(f"{path} exists")
    plain = T.StructType([f for f in schema.fields if f.name != PERIOD])
    where = path if len(plain) == len(schema) else f"{path.rstrip('/')}/{PERIOD}=__HIVE_DEFAULT_PARTITION__"
    spark.createDataFrame([], plain).write.mode("errorifexists").parquet(where)
    log_schema(spark, path, schema)


def in_periods_of(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The rows of a split target in the batch's periods; the filter is on the partition column, so other folders aren't read."""
    if PERIOD not in target.columns or column not in batch.columns:
        return target
    months = batch.select(period_of(column).alias("p")).where("p IS NOT NULL").distinct()
    listed = sorted(r["p"] for r in months.limit(LISTED_PERIODS + 1).collect())
    if len(listed) <= LISTED_PERIODS:
        return target.where(F.col(PERIOD).isin(listed)) if listed else target.limit(0)
    low, high = months.agg(F.min("p"), F.max("p")).first()
    return target.where(F.col(PERIOD).between(low, high))


_RANGE_TYPES = (*_TIMES, T.LongType, T.IntegerType, T.DoubleType, T.StringType)


def bound_target(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Restrict the target to the batch's [min, max] of one key column.

    The bounds come from one aggregate over the (materialized) batch; the filter reaches the target's
    Parquet scan, so row groups outside the range are skipped. A NULL key never matches, so dropping
    target rows with a NULL in that column does not change the anti-join.
    """
    if column not in target.columns or not isinstance(batch.schema[column].dataType, _RANGE_TYPES):
        return target
    dtype = batch.schema[column].dataType
    # bounds travel as text and are cast back to the column's type: exact and time-zone free
    lo, hi = batch.agg(F.min(quoted(column)).cast("string"), F.max(quoted(column)).cast("string")).first()
    if lo is None:
        return target.limit(0)
    return target.filter(quoted(column).between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype)))


def append(new: DataFrame, path: str, rows: int, sort_by: str | None, period: str | None = None) -> None:
    """K2: add rows (``new`` is written already, ``rows`` its count).

    A split table's rows go by (period, key) ranges to as many tasks as files are due: a task writes few folders, and
    a month of very many rows is split over tasks. Rows are sorted by the key in each file, for tight row-group statistics.
    """
    if period is not None:
        keyed = new.withColumn(PERIOD, period_of(period))
        order = [F.col(PERIOD), *([quoted(sort_by)] if sort_by else [])]
        files = max(1, -(-rows // ROWS_PER_FILE))
        keyed.repartitionByRange(files, *order, F.xxhash64(*[quoted(c) for c in new.columns])).sortWithinPartitions(*order).write.mode("append").partitionBy(PERIOD).parquet(path)
        return
    (new.sortWithinPartitions(quoted(sort_by)) if sort_by else new).write.mode("append").parquet(path)
