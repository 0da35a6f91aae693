"""The load ledger (which table/period/file has been loaded).

The ledger is an append-only Parquet table:

    table_name string, year int, month int, source_file string, rows_loaded bigint, loaded_at timestamp_ntz,
    size bigint, modified timestamp

``size`` and ``modified`` tell a file delivered again under its old path from the one that was loaded.
The original's monthly ledger is ``select distinct table_name, year, month`` of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.session import materialize, path_exists

LEDGER_SCHEMA = "table_name string, year int, month int, source_file string, rows_loaded bigint, loaded_at timestamp_ntz, size bigint, modified timestamp"
_MONTH_KEY = ["table_name", "year", "month"]


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    """The ledger, or an empty frame with its schema when nothing was recorded yet."""
    if path and path_exists(path, spark):
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_months(ledger: DataFrame) -> DataFrame:
    return ledger.select(*_MONTH_KEY).filter(F.col("year").isNotNull() & F.col("month").isNotNull()).distinct()


def ledger_skip(candidates: DataFrame, ledger: DataFrame, grain: str = "file") -> DataFrame:
    """F8: drop candidate files already covered by the ledger.

    ``candidates`` has ``source_file``, ``table_name`` (lower case), ``year``, ``month``.
    ``grain='file'`` (default, V1) skips a file that was itself loaded. ``grain='month'`` reproduces
    the original: a (table, year, month) in the ledger blocks every file of it, and within one run only
    the first file (sorted path order) of a (table, year, month) is taken. Files of unknown period
    (year or month NULL/0) are never skipped by the month rule.
    """
    if grain == "file":
        if not {"size", "modified"} <= set(candidates.columns) & set(ledger.columns):
            return candidates.join(ledger.select("source_file").distinct(), "source_file", "left_anti")
        c, done = candidates.alias("c"), ledger.select("source_file", "size", "modified").distinct().alias("done")
        unchanged = F.col("done.size").isNull() | ((F.col("c.size") == F.col("done.size")) & (F.col("c.modified") == F.col("done.modified")))
        return c.join(done, (F.col("c.source_file") == F.col("done.source_file")) & unchanged, "left_anti")
    if grain != "month":
        raise ValueError("grain must be 'file' or 'month'")
    known = F.col("year").isNotNull() & F.col("month").isNotNull() & (F.col("year") != 0) & (F.col("month") != 0)
    fresh = candidates.join(ledger_months(ledger), _MONTH_KEY, "left_anti")
    # one aggregate: a file of unknown period is a group of its own, the others keep their month's first file
    group = [F.when(known, F.col(k)).alias(f"_{k}") for k in _MONTH_KEY] + [F.when(~known, F.col("source_file")).alias("_file")]
    rest = [c for c in candidates.columns if c != "source_file"]
    row = F.struct("source_file", *[F.col(c).alias(f"v{i}") for i, c in enumerate(rest)])
    picked = fresh.groupBy(*group).agg(F.min_by(row, F.col("source_file")).alias("r"))
    out = {"source_file": F.col("r.source_file"), **{c: F.col(f"r.v{i}").alias(c) for i, c in enumerate(rest)}}
    return picked.select(*[out[c] for c in candidates.columns])


def ledger_mark(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    """K3: append entries not already present (null-safe on table, period and file); returns them.

    The new rows are checkpointed before the append, so the write does not re-read the ledger it adds to.
    """
    current = read_ledger(spark, path).select(*_MONTH_KEY, "source_file", "size", "modified").alias("c")
    cand = (
        entries.select(
            F.lower("table_name").alias("table_name"), "year", "month", "source_file", "rows_loaded",
            *[(F.col(c) if c in entries.columns else F.lit(None)).cast(t).alias(c) for c, t in (("size", "bigint"), ("modified", "timestamp"))],
        )
        .dropDuplicates(["table_name", "year", "month", "source_file"])
        .alias("n")
    )
    same = None
    for k in [*_MONTH_KEY, "source_file"]:
        eq = F.col(f"n.{k}").eqNullSafe(F.col(f"c.{k}"))
        same = eq if same is None else same & eq
    # a file delivered again is a new entry
    again = F.col("n.size").isNotNull() & F.col("c.size").isNotNull() & ((F.col("n.size") != F.col("c.size")) | (F.col("n.modified") != F.col("c.modified")))
    same = same & ~again
    new = (
        cand.join(current, same, "left_anti")
        .withColumn("loaded_at", F.localtimestamp())
        .select("table_name", "year", "month", "source_file", "rows_loaded", "loaded_at", "size", "modified")
    )
    new = materialize(new, "ledger-new")
    new.write.mode("append").parquet(path)
    return new
