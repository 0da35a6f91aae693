"""Packing of tokenized documents into windows by best-fit decreasing.

A document's ids (with its end id) are first cut into full windows; the tails, longest first, go to the open window
with the tightest remaining capacity that holds them, found by a segment tree over capacities. Tails are dealt by a
hash of their row numbers into groups of about ``group_pieces`` (their number follows the data), each packed by one task; full
windows are sequences of their own and are not moved. Only piece records are shuffled unless ids are asked for.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import ARROW, settle, table, text_blocks
from voltline.llm.wordbpe import encoder
from voltline.session import materialize, ship_package


@dataclass(frozen=True)
class PackConfig:
    window: int = 2048
    end_id: int = 1
    group_pieces: int = 20_000
    tokenizer_path: str | None = None  # of the public word-end vocabulary; resolved where the task runs


class CapacityTree:
    """Segment tree over capacities 0..window: how many open windows have each remaining capacity."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, item: int) -> None:
        self.open[capacity].append(item)
        node = capacity + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, item) of an open window with the least capacity of at least ``need``; it is removed."""
        node = need + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up to a right sibling that has some
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.size
        item = self.open[capacity].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return capacity, item


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece; ``lengths`` come longest first and lie in 1..window."""
    tree, out, opened = CapacityTree(window), [], 0
    for n in lengths:
        found = tree.take(n)
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, seq = found
        out.append((seq, window - capacity))
        tree.add(capacity - n, seq)
    return out


#: Bytes of text encoded at once: the new words of a block go through one merge call.
ENCODE_BYTES = 1 << 20
PIECE = {"start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long"}


def pieces(docs: DataFrame, id_col: str, text_col: str, cfg: PackConfig, keep_ids: bool = False) -> DataFrame:
    """Windows and tail of each row's ids; a null or empty text is the end id alone."""
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    fields = PIECE | ({"ids": "binary"} if keep_ids else {})
    step = 4 * cfg.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(cfg.tokenizer_path)
        end = cfg.end_id.to_bytes(4, "little")
        for batch in batches:
            for part, texts in text_blocks(batch.column(1), ENCODE_BYTES):
                rows: list[tuple] = []
                owner: list[int] = []
                for i, ids in enumerate(enc.encode(texts)):
                    ids += end
                    for s in range(0, len(ids), step):
                        own = ids[s : s + step]
                        rows.append((s // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4, own))
                        owner.append(part.start + i)
                cols = [batch.column(0).take(pa.array(owner))]
                cols += [pa.array([r[k] for r in rows], ARROW[t]) for k, t in enumerate(fields.values())]
                yield pa.RecordBatch.from_arrays(cols, names=[id_col, *fields])
        settle()

    schema = ", ".join(f"`{k}` {v}" for k, v in [(id_col, src.schema["_id"].dataType.simpleString()), *fields.items()])
    return src.mapInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: PackConfig = PackConfig(), keep_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; with ``keep_ids`` also its ids (little-endian u32).

    Sequence ids are unique, not consecutive. Repeated rows are packed each; null ids stay null; an empty table gives
    no rows. The pieces are written once (their row numbers fix the groups, whatever tasks run again).
    """
    spark = docs.sparkSession
    cut = pieces(docs, id_col, text_col, cfg, keep_ids).withColumn("_row", F.monotonically_increasing_id())
    written, n = materialize(cut, "pieces", with_count=True)
    full = written.where(F.col("length") == cfg.window)
    whole = full.withColumn("sequence_id", F.col("_row") * 2 + 1).withColumn("offset", F.lit(0).cast("long"))
    groups = max(1, math.ceil(n / cfg.group_pieces))
    tails = written.where(F.col("length") < cfg.window).withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("long"))
    window = cfg.window

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("_row", "ascending")])
        placed = best_fit_decreasing(group.column("length").to_pylist(), window)
        number = group.column("_group")[0].as_py()
        ids = pa.array([((number << 32) + s) * 2 for s, _ in placed], pa.int64())
        return group.drop_columns(["_group"]).append_column("sequence_id", ids).append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    names = [c for c in tails.columns if c != "_group"]
    schema = ", ".join(f"`{c}` {t}" for c, t in tails.dtypes if c != "_group") + ", sequence_id long, offset long"
    packed = tails.groupBy("_group").applyInArrow(run, schema)
    return whole.select(*names, "sequence_id", "offset").unionByName(packed).drop("_row")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pack`` of all of ``documents`` into windows of 2,048 ids; a null text is its end id alone, texts of any length are cut whole."""
    return pack(table(spark, sf_dir, "documents"))
