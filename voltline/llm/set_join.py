"""N-gram Jaccard self-join: components of documents whose sets of word shingles are similar, exactly.

Equal sets collapse to one class first. Each class is indexed by its prefix: its rarest shingles, by a sketch of all
shingle counts (fixed size, so any corpus fits; the order only steers work, never results). The lists of the index
are joined with skipping (``linking``): blocks are skipped by size, position and known components, and most pairs
are answered from the differences to a similar set that was compared before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import map_texts, small_batches, table, text_blocks
from voltline.llm.linking import BROADCAST_ROWS, Similarity, named, rows_and_classes, sets_of, text_key, with_components
from voltline.llm.textarrays import shingles, words_of
from voltline.session import materialize, ship_package

#: Counters of the sketch and the pieces in which tasks' counters are added up.
SKETCH, SLICES = 1 << 19, 64


def shingle_counts(docs: DataFrame, text_col: str, sim: Similarity) -> np.ndarray:
    """Counts of all shingles of all texts by hash, ``SKETCH`` numbers, added up in two levels."""
    ship_package(docs.sparkSession)
    width = SKETCH // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for _, texts in text_blocks(batch.column(0)):
                _, h = shingles(words_of(texts, sim.lower), sim.shingle)
                total += np.bincount((h >> np.uint64(45)).astype(np.int64), minlength=SKETCH)
        yield rows(range(SLICES), [total[i * width : (i + 1) * width] for i in range(SLICES)])

    def rows(ids, parts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(ids), pa.int32()), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], names=["piece", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), "<i8") for c in group.column("counts"))
        return pa.Table.from_batches([rows([group.column("piece")[0].as_py()], [total])])

    own = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).mapInArrow(count, "piece int, counts binary")
    some = own.withColumn("task", F.spark_partition_id() % 256).groupBy("piece", "task").applyInArrow(add, "piece int, counts binary")
    got = some.groupBy("piece").applyInArrow(add, "piece int, counts binary").collect()  # SKETCH numbers in all
    out = np.zeros(SKETCH, np.int64)
    for r in got:
        out[r[0] * width : (r[0] + 1) * width] = np.frombuffer(r[1], "<i8")
    return out


def set_rows(docs: DataFrame, id_col: str, text_col: str, sim: Similarity) -> DataFrame:
    """(id, n, k1, k2, tkey, parity, keys) of each row: size and key of its set, and its prefix, rarest first."""
    spark = docs.sparkSession
    counts = shingle_counts(docs, text_col, sim)
    rank = spark.sparkContext.broadcast(np.minimum(counts, (1 << 20) - 1).astype(np.uint32))  # SKETCH x 4 bytes

    def run(texts: list[str]) -> dict[str, list]:
        s = sets_of(texts, sim)
        n = np.diff(s.off)
        key = rank.value[(s.hash >> np.uint64(45)).astype(np.int64)].astype(np.uint64) << np.uint64(43) | s.hash >> np.uint64(21)
        key = key[np.lexsort((key, s.doc))].astype(np.int64)
        take = np.where(n >= sim.least_size, sim.prefix(n), 0)
        return {"n": n, "k1": s.k1, "k2": s.k2, "parity": s.parity(), "keys": [key[a : a + k] for a, k in zip(s.off[:-1].tolist(), take.tolist())]}

    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.struct(F.col(id_col).alias("id"), text_key(clean).alias("tkey")).alias("_who"), clean.alias("_text"))
    got = map_texts(named, "_who", "_text", run, {"n": "long", "k1": "long", "k2": "long", "parity": "binary", "keys": "array<long>"})
    return got.select(F.col("_who.id").alias(id_col), F.col("_who.tkey").alias("tkey"), "n", "k1", "k2", "parity", "keys")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sim: Similarity = Similarity()) -> DataFrame:
    """(id, n_shingles, component_id) of each row: the least id that links reach, itself included.

    A text without words (null, empty, blank) has no shingles and is alone. Rows of equal texts share a component;
    a null id never names a component unless all its rows' ids are null. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        rows, classes = rows_and_classes(set_rows(docs.select(id_col, text_col), id_col, text_col, sim), id_col)
        return named(rows, with_components(classes, docs, text_col, sim, positional=True), id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sim: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` with one of each group of linked rows: that of the least id, then text key; null ids last.

    Of rows that are equal in id and text one stays; rows without words are linked with nothing and all stay. Only
    the keys of dropped rows meet the documents, by broadcast while they are few."""
    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    who = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text_key(clean).alias("text"))
    found = materialize(similar_components(docs.select(who.alias("_who"), F.col(text_col)), "_who", text_col, sim), "grouped-docs")
    worded = found.where("n_shingles > 0")
    lost, n = materialize(worded.where("_who != component_id").select("_who").distinct(), "lost", with_count=True)
    again, m = materialize(worded.where("_who = component_id").groupBy("_who").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_who"), "again", with_count=True)
    marked = docs.withColumn("_who", who)
    kept = marked.join(F.broadcast(lost) if n <= BROADCAST_ROWS else lost, "_who", "left_anti")
    if m:  # rows that repeat as they are
        keys = F.broadcast(again) if m <= BROADCAST_ROWS else again
        kept = kept.join(keys, "_who", "left_anti").unionByName(kept.join(keys, "_who", "left_semi").dropDuplicates(["_who"]))
    return kept.select(*docs.columns)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all of ``documents`` by three-word shingles at 0.9; documents without words are alone, repeats are one set."""
    return similar_components(table(spark, sf_dir, "documents"))
