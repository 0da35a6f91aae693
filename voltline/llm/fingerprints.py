"""Document fingerprints by MinHash, near copies by signature bands.

A text's fingerprint is the minimum of each of ``perms`` universal hash permutations x -> a*x + b (a odd, modulo
2^32) over its word shingles, kept to 16 bits each, as hex: equal texts have equal fingerprints, and the share of
equal places estimates the Jaccard similarity of the shingle sets. Signatures are computed in numpy, block by block.
Near copies are found through signature bands joined in Spark; each candidate's Jaccard similarity is verified.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import map_texts, small_batches, table
from voltline.llm.linking import PARITY, Similarity, named, rows_and_classes, sets_of, text_key, with_components
from voltline.llm.textarrays import mix, shingles, words_of
from voltline.session import ship_package


@dataclass(frozen=True)
class MinHashConfig:
    perms: int = 128
    shingle: int = 5
    seed: int = 11
    band_rows: int = 4  # perms / band_rows bands: at Jaccard 0.8 a pair shares none of 32 bands once in 2 * 10^7
    similarity: tuple[int, int] = (80, 100)
    rounds: int = 4  # of neighbour proposals: a hot band's list has no positions that exclude pairs

    @property
    def sets(self) -> Similarity:
        return Similarity(self.shingle, *self.similarity, lower=False)


def _permutations(cfg: MinHashConfig) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(cfg.seed)
    return rng.integers(0, 1 << 32, cfg.perms, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, cfg.perms, np.uint32)


def signatures(texts: list[str], cfg: MinHashConfig) -> np.ndarray:
    """texts x perms minima (32 bits); a text without words has all bits set."""
    doc, sh = shingles(words_of(texts), cfg.shingle)
    a, b = _permutations(cfg)
    out = np.full((len(texts), cfg.perms), np.uint32(0xFFFFFFFF))
    x = (sh >> np.uint64(32)).astype(np.uint32)
    step = 512  # shingles whose products are held at once: they fit the processor's cache
    if len(doc):
        for i in range(0, len(x), step):
            d = doc[i : i + step]
            first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            m = np.minimum.reduceat(x[i : i + step, None] * a + b, first, axis=0)
            out[d[first]] = np.minimum(out[d[first]], m)
    return out


def _short(sig: np.ndarray) -> np.ndarray:
    return (sig >> np.uint32(16)).astype(">u2")


def _hex(short: np.ndarray) -> list[str]:
    raw, n = short.tobytes().hex(), short.shape[1] * 4
    return [raw[i : i + n] for i in range(0, len(raw), n)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: MinHashConfig = MinHashConfig()) -> DataFrame:
    """(id, fingerprint) of each row; null texts count as empty, whose fingerprint is all ones."""
    return map_texts(docs, id_col, text_col, lambda t: {"fingerprint": _hex(_short(signatures(t, cfg)))}, {"fingerprint": "string"})


# --- near copies ------------------------------------------------------------------------------


def band_rows(docs: DataFrame, id_col: str, text_col: str, cfg: MinHashConfig) -> DataFrame:
    """(id, tkey, n, k1, k2, parity, keys) of each row: size and key of its shingle set, and a key for each signature band."""
    sim = cfg.sets

    def run(texts: list[str]) -> dict[str, list]:
        s = sets_of(texts, sim)
        n = np.diff(s.off)
        rows = signatures(texts, cfg).reshape(len(texts), -1, cfg.band_rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(rows.shape[1], dtype=np.uint64), rows.shape[:2])
        for j in range(cfg.band_rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
        return {"n": n, "k1": s.k1, "k2": s.k2, "parity": s.parity(), "keys": [k if m else [] for k, m in zip(key.view(np.int64), n.tolist())]}

    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    who = docs.select(F.struct(F.col(id_col).alias("id"), text_key(clean).alias("tkey")).alias("_who"), clean.alias("_text"))
    got = map_texts(who, "_who", "_text", run, {"n": "long", "k1": "long", "k2": "long", "parity": "binary", "keys": "array<long>"})
    return got.select(F.col("_who.id").alias(id_col), F.col("_who.tkey").alias("tkey"), "n", "k1", "k2", "parity", "keys")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: MinHashConfig = MinHashConfig()) -> DataFrame:
    """(id, n_shingles, component_id) of each row: the least id reached by verified links of pairs that share a band.

    Equal sets are one class before the bands are joined, lists of a hot band are cut into blocks, and a candidate's
    similarity is exact. Texts without words are alone; null ids as in the set join."""
    with small_batches(docs.sparkSession):
        rows, classes = rows_and_classes(band_rows(docs.select(id_col, text_col), id_col, text_col, cfg), id_col)
        return named(rows, with_components(classes, docs, text_col, cfg.sets, positional=False, rounds=cfg.rounds, folded=PARITY), id_col)


# --- a document, its edited text and the next document ----------------------------------------


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


#: Characters of consecutive documents that are fingerprinted at once.
CHAIN_CHARS = 1 << 18
GROUP = {"n_shingles": "long", "component_id": "long"}
EDIT = {"n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: MinHashConfig = MinHashConfig(), groups: DataFrame | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text (second half replaced from the next document), and likenesses.

    Documents follow each other by id, then text; null ids come first and the first document follows the last. The
    rows are dealt into id ranges by bounds from quantiles of all ids; only the first id's rows of a range are sent
    to the range before too, so a text moves once. Each range is read in order, a block at a time. An empty table
    gives no rows; a single document follows itself.

    ``groups`` (_who, n_shingles, component_id), keyed by id and text as in ``likeness_and_copies``, is dealt along
    with the documents and its columns follow; the keys of one id are held while its rows are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("_id"), clean.alias("_text"), text_key(clean).alias("_tkey"))
    fields = EDIT if groups is None else EDIT | GROUP
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(np.array(src.approxQuantile("_id", [i / parts for i in range(1, parts)], 0.2 / parts) or [], dtype=float))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(bounds, ids.fillna(0).to_numpy(float), "right")).astype(np.int32))

    # the least id of each non-empty range: one row per range
    least = src.select("_id").withColumn("_range", range_of("_id")).groupBy("_range").agg(F.min(F.struct(F.col("_id").isNotNull(), "_id")).alias("m"))
    firsts = {r[0]: r[1][1] for r in least.collect()}  # at most one row per range
    order = sorted(firsts)
    before = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # first id of a range -> the range before it
    ids, targets = [k for k in before if k is not None], [v for k, v in before.items() if k is not None]
    look = {int(k): int(v) for k, v in zip(ids, targets)}
    null_target = before.get(None, -1)

    @F.pandas_udf("int")
    def halo_of(x: pd.Series, none: pd.Series) -> pd.Series:
        return pd.Series([null_target if no else look.get(v, -1) for v, no in zip(x.tolist(), none.tolist())], dtype="int32")

    # ids without nulls stay whole numbers, however large
    own = src.withColumn("_range", range_of("_id")).withColumn("_halo", halo_of(F.coalesce("_id", F.lit(0)), F.col("_id").isNull()))
    copies = F.when(F.col("_halo") >= 0, F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("h")), F.struct(F.col("_halo").alias("r"), F.lit(True).alias("h"))))
    copies = copies.otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("h"))))
    dealt = own.select("_id", "_text", "_tkey", F.explode(copies).alias("_at")).select(F.col("_at.r").alias("_range"), F.col("_at.h").alias("_next"), "_id", "_text", "_tkey")
    if groups is not None:  # rows without a text: they sort before the documents of their id
        facts = groups.select(F.col("_who.id").alias("_id"), F.col("_who.text").alias("_tkey"), F.col("n_shingles").alias("_n"), F.col("component_id.id").alias("_least"))
        facts = facts.select(range_of("_id").alias("_range"), F.lit(False).alias("_next"), "_id", F.lit(None).cast("string").alias("_text"), "_tkey", "_n", "_least")
        dealt = dealt.unionByName(facts, allowMissingColumns=True)
    sorted_rows = dealt.repartitionById(parts, F.col("_range")).sortWithinPartitions("_range", "_next", F.col("_id").asc_nulls_first(), "_text")

    groups_too = groups is not None

    def emit(chain: list[tuple], after: str | None) -> pa.RecordBatch:
        """Rows of consecutive documents of one range; the document after the last, if it is not in the chain."""
        texts = [c[1] for c in chain]
        follow = [*texts[1:], after]
        n = len(chain)
        edited = [_edited(t, f) for t, f in zip(texts, follow)]
        short = _short(signatures([*texts, after, *edited], cfg))
        cols = [
            pa.array([c[0] for c in chain], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(_hex(short[:n])), pa.array(_hex(short[n + 1 :])),
            pa.array((short[:n] == short[n + 1 :]).mean(1)), pa.array((short[:n] == short[1 : n + 1]).mean(1)),
        ]
        if groups_too:
            cols += [pa.array([c[j] for c in chain], pa.int64()) for j in (2, 3)]
        return pa.RecordBatch.from_arrays(cols, names=[id_col, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[tuple] = []
        size, at, done = 0, None, False  # done: the range's follower has come
        known: dict[int, tuple] = {}  # text key -> group of the rows of one id
        whose: tuple = ()
        for batch in batches:
            for r, halo, i, t, key, *group in zip(*(c.to_pylist() for c in batch.columns)):
                if t is None:
                    if whose != (i,):
                        known, whose = {}, (i,)
                    known[key] = tuple(group)
                    continue
                if r != at:
                    if chain:  # a range without a follower row cannot be: every range's first rows go to one before
                        yield emit(chain, chain[0][1])
                    chain, size, at, done = [], 0, r, False
                if halo:
                    if not done and chain:
                        yield emit(chain, t)
                        chain, done = [], True
                    continue
                if chain and size > CHAIN_CHARS:
                    yield emit(chain, t)
                    chain, size = [], 0
                chain.append((i, t, *known[key]) if groups_too else (i, t))
                size += len(t)
        if chain:
            yield emit(chain, chain[0][1])

    return sorted_rows.mapInArrow(run, f"`{id_col}` long, " + ", ".join(f"{k} {v}" for k, v in fields.items()))


def likeness_and_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cfg: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``edit_likeness`` of each row with n_shingles and component_id of ``near_copies``.

    Groups meet the rows by id and text, so rows that repeat an id keep their own group; null ids name a group only
    where all its ids are null."""
    clean = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    who = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).cast("long").alias("id"), text_key(clean).alias("text"))
    groups = near_copies(docs.select(who.alias("_who"), F.col(text_col)), "_who", text_col, cfg)
    return edit_likeness(docs, id_col, text_col, cfg, groups)


def op10_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``likeness_and_copies`` of every whole text of ``documents``: null texts count as empty, equal texts have equal fingerprints,
    documents follow by id, then text; an empty table gives no rows."""
    return likeness_and_copies(table(spark, sf_dir, "documents"))
