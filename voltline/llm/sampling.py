"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows of smallest key hash (repeatable; all rows when there are fewer), more only if ids repeat.

    Only hashes are sorted; the rows themselves are filtered by the last hash, so texts don't move. Callers put
    ``limit(rows)`` behind what they make of the rows.
    """
    h = F.xxhash64(F.lit("sample"), F.col(key))
    last = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(h <= F.lit(last)) if last is not None else df.limit(0)


def bounded_sample_of_each(df: DataFrame, key: str, rows: int, group: str, least: int) -> tuple[DataFrame, int]:
    """``bounded_sample`` with the ``least`` rows of smallest key hash of each group besides; and the most rows that is.

    Only hashes are ranked; Spark keeps the first ``least`` of a group in each task before they move. Groups, a row
    each, are broadcast."""
    h = F.xxhash64(F.lit("sample"), F.col(key))
    first = F.row_number().over(Window.partitionBy("_group").orderBy("h"))
    ranked = df.select(F.col(group).alias("_group"), h.alias("h")).withColumn("rank", first).where(F.col("rank") <= least)
    ends = ranked.groupBy("_group").agg(F.max("h").alias("_end")).collect()
    if not ends:
        return df.limit(0), 0
    last = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    bounds = df.sparkSession.createDataFrame([(r[0], max(r[1], last)) for r in ends], f"_group {df.schema[group].dataType.simpleString()}, _end long")
    chosen = df.join(F.broadcast(bounds), F.col(group) == F.col("_group")).where(h <= F.col("_end")).select(*df.columns)
    return chosen, rows + least * len(ends)


def within_budget(sample: DataFrame, key: str, text: str, budget: int, group: str | None = None) -> DataFrame:
    """Rows of a bounded ``sample`` in order of their key's hash until their texts hold ``budget`` characters together.

    A row's own size doesn't choose it: rows are taken as they come, and the first always stays. With ``group`` each group
    (a few labels) has an equal part of the budget. Only hashes and sizes, a row for each key, come to the driver.
    """
    h = F.xxhash64(F.lit("sample"), F.col(key))
    g = F.col(group) if group else F.lit(0)
    sizes = sample.groupBy(g.alias("g"), h.alias("h")).agg(F.sum(F.coalesce(F.char_length(text), F.lit(0))).alias("n")).orderBy("g", "h").collect()
    groups = {r.g for r in sizes}
    keep = F.lit(False)
    for one in groups:
        total, last = 0, None
        for r in (r for r in sizes if r.g == one):
            total += r.n
            if last is not None and total > budget // len(groups):
                break
            last = r.h
        keep = keep | (g.eqNullSafe(F.lit(one)) & (h <= F.lit(last)))
    return sample.where(keep)
