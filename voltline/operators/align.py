"""Bind a batch to a target schema.

E1 fills target columns the batch lacks with typed NULLs, E2 projects to target order and drops
columns the target does not know (their names are reported, V5), E3 casts to target types and
splits off rows whose values do not convert.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.functions.text import quoted
from voltline.operators.infer import cast_string_column, is_datetime_name


@dataclass
class Aligned:
    frame: DataFrame
    added: list[str]
    dropped: list[str]


def align_schema(batch: DataFrame, target: T.StructType, extra: str = "drop", keep: Sequence[str] = ()) -> Aligned:
    """Project ``batch`` onto ``target`` by exact (case-sensitive) name.

    ``extra='drop'`` (default) drops unknown columns; ``extra='add'`` appends them after the target
    columns. ``keep`` names lineage columns carried through unchanged.
    """
    have = set(batch.columns)
    names = [f.name for f in target.fields]
    added = [f.name for f in target.fields if f.name not in have]
    dropped = [c for c in batch.columns if c not in set(names) and c not in set(keep)]
    cols = [quoted(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    if extra == "add":
        cols += [quoted(c) for c in dropped]
        dropped = []
    elif extra != "drop":
        raise ValueError("extra must be 'drop' or 'add'")
    cols += [quoted(c) for c in keep if c in have]
    return Aligned(batch.select(*cols), added, dropped)


def _convert(name: str, source: T.DataType, target: T.DataType, strict: bool):
    if isinstance(source, T.StringType) and not isinstance(target, T.StringType):
        return cast_string_column(name, target, strict)
    c = quoted(name)
    return (c.cast(target) if strict else c.try_cast(target)).alias(name)


def cast_to_target(batch: DataFrame, target: T.StructType, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cast columns named in ``target``; returns (good rows, rejected rows with a reason).

    A row is rejected when a non-NULL value turns NULL in the cast, except in a timestamp column whose name
    says date or time: there unparseable text is NULL on every load, the first and later ones (P9). With
    ``strict`` an unconvertible value fails the job (ANSI cast) instead. Each value is converted once: the converted and the
    original columns sit side by side in one projection, and both outputs select from it.
    """
    types = {f.name: f.dataType for f in target.fields}
    src = {f.name: f.dataType for f in batch.schema.fields}
    changing = [c for c in batch.columns if c in types and src[c] != types[c]]
    if strict or not changing:
        casted = [_convert(c, src[c], types[c], strict) if c in changing else quoted(c) for c in batch.columns]
        return batch.select(*casted), batch.limit(0).withColumn("_reject_reason", F.lit(None).cast("string"))
    orig = {c: f"_orig_{i}" for i, c in enumerate(changing)}
    both = batch.select(
        *[_convert(c, src[c], types[c], False) if c in orig else quoted(c) for c in batch.columns],
        *[quoted(c).alias(o) for c, o in orig.items()],
    )
    coerced = {c for c in changing if is_datetime_name(c) and isinstance(types[c], (T.TimestampNTZType, T.TimestampType))}
    lost = [F.when(F.col(o).isNotNull() & quoted(c).isNull(), F.lit(c)) for c, o in orig.items() if c not in coerced]
    reason = F.concat_ws(",", *lost)
    flagged = both.withColumn("_reject_reason", F.when(reason != "", F.concat(F.lit("unconvertible: "), reason)))
    good = flagged.filter(F.col("_reject_reason").isNull()).select(*[quoted(c) for c in batch.columns])
    bad = flagged.filter(F.col("_reject_reason").isNotNull()).select(
        *[F.col(orig[c]).alias(c) if c in orig else quoted(c) for c in batch.columns], "_reject_reason"
    )
    return good, bad
