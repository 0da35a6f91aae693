"""First-wins dedupe, insert-only anti-join, primary-key audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.functions.text import quoted

# batches whose distinct keys take at most this many bytes (64 for a text) take the broadcast semi-join route of J1
BROADCAST_KEY_BYTES = 64 << 20


def dedupe_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key in ``order`` (NULL keys compare equal, as in the original).

    Written as an aggregate, not a window: ``min(struct(order..., rest...))`` is combined on the map
    side, so a key holding a third of all rows is reduced to one row per partition before the shuffle.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    packed = F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[quoted(c).alias(f"v{i}") for i, c in enumerate(rest)])
    agg = df.groupBy(*[quoted(k) for k in key]).agg(F.min(packed).alias("_first"))
    out = {k: quoted(k) for k in key}
    out.update({c: F.col(f"_first.v{i}").alias(c) for i, c in enumerate(rest)})
    return agg.select(*[out[c].alias(c) for c in df.columns])


def anti_join_new(batch: DataFrame, target: DataFrame, key: Sequence[str], known_keys: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (SQL equality: a NULL key never matches).

    The target is the big side and Spark can only broadcast the right side of an anti-join, so when
    the batch has a bounded number of keys the target is first semi-joined against the broadcast
    batch keys (target streamed, never shuffled); the result is at most that many keys and is
    broadcast back into the anti-join. Beyond the bound both sides are shuffled on the key.
    """
    key = list(key)
    plain = {k: f"_k{i}" for i, k in enumerate(key)}  # join columns, whatever the names hold
    on = list(plain.values())
    wide = batch.select("*", *[quoted(k).alias(p) for k, p in plain.items()])
    existing = target.select(*[quoted(k).alias(p) for k, p in plain.items()])
    keys = wide.select(*on).dropDuplicates()
    n = known_keys if known_keys is not None else keys.count()
    row_bytes = sum(8 if f.dataType.simpleString() not in ("string", "binary") else 64 for f in keys.schema.fields)
    if n * row_bytes <= BROADCAST_KEY_BYTES:
        existing = F.broadcast(existing.join(F.broadcast(keys), on, "left_semi").dropDuplicates())
    return wide.join(existing, on, "left_anti").drop(*on)


def pk_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, null_keys, dup_groups, surplus_rows (rows beyond the first of a duplicated key)."""
    key = list(key)
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"), F.max(any_null.cast("int")).alias("has_null"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("has_null") == 1, F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if((F.col("has_null") == 0) & (F.col("n") > 1)).cast("bigint").alias("dup_groups"),
        F.coalesce(F.sum(F.when((F.col("has_null") == 0) & (F.col("n") > 1), F.col("n") - 1)), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )
