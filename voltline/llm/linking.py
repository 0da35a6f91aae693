"""Links between sets of word shingles that share index keys, without comparing all pairs of a key's list.

Input: one row per distinct set (class) with its size, index keys and a parity bitmap. Lists of one entry are
dropped in the first pass; all later steps see the lists of two and more.

1. Each key's list, ordered by size, proposes its first set of similar size as head to the others; a set takes the
   head that most of its keys propose, so at most one comparison per set. The comparison keeps the symmetric
   difference to the head.
2. In a few rounds each list, in a random order of its own, proposes neighbours of different components; their
   links join components. Proposals are as many as list entries.
3. Lists are cut into blocks with bounds of size, remaining positions and component. Two blocks are joined unless
   the bounds exclude every pair: sizes too different, too few positions left for the overlap, or all of one
   component already. Pairs of different components come out unless size, position or bitmap exclude them.

A pair under one head is decided from the two differences alone: the symmetric difference of two sets is that of
their differences to a third. Of other pairs, those whose bitmaps differ in more bits than a link's symmetric
difference allows are no links (each differing bit needs an element of its own); the rest are compared by texts.

So a group of many similar sets costs a few comparisons each and few blocks, and no link between different components
is lost: a pair is left out only if it cannot reach the similarity or is connected by links already found.
Lists are range-partitioned by (key, size, set), so a hot key spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.llm.components import components
from voltline.llm.textarrays import mix, shingles, words_of
from voltline.session import drop_frame, drop_scratch, materialize, scratch_made, ship_package

#: Rows of a table of (long, long) that may be broadcast, counted before.
BROADCAST_ROWS = 500_000
#: Entries of a block of a list.
BLOCK = 256
#: Rounds of neighbour proposals before all remaining pairs are looked for.
ROUNDS = 2
#: Bits of a class's parity bitmap, and of its folded form in the blocks of the exact prefix lists.
PARITY, FOLDED = 1024, 256


@dataclass(frozen=True)
class Similarity:
    """Sets link when den * intersection >= num * union; ``shingle`` words each, ASCII capitals lowered if ``lower``."""

    shingle: int = 3
    num: int = 90
    den: int = 100
    lower: bool = True

    @property
    def least_size(self) -> int:
        """Smaller sets link with equal sets only."""
        return -(-self.num // (self.den - self.num))

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Tokens of a set of n among which any linked set shares one, in one order of all tokens."""
        return n - -(-self.num * n // self.den) + 1


# --- sets of texts -----------------------------------------------------------------------------


@dataclass
class Sets:
    """Distinct shingles of a block of texts, sorted by text: hashes, bounds, and 128-bit keys of whole sets."""

    doc: np.ndarray
    hash: np.ndarray
    off: np.ndarray
    k1: np.ndarray
    k2: np.ndarray

    def parity(self) -> list[bytes]:
        """Bitmap of each set: bit i says whether an odd number of its elements hash to i."""
        n = len(self.off) - 1
        bits = np.zeros((n, PARITY), np.uint8)
        flat = np.bincount(self.doc * PARITY + (self.hash >> np.uint64(11) & np.uint64(PARITY - 1)).astype(np.int64), minlength=n * PARITY) if len(self.doc) else bits
        raw = np.packbits((flat & 1).astype(np.uint8).reshape(n, PARITY), axis=1).tobytes()
        return [raw[i : i + PARITY // 8] for i in range(0, len(raw), PARITY // 8)]


def sets_of(texts: list[str], sim: Similarity) -> Sets:
    doc, h = shingles(words_of(texts, sim.lower), sim.shingle)
    _, keep = np.unique(mix(h + mix(doc.astype(np.uint64))), return_index=True)
    keep.sort()
    doc, h = doc[keep], h[keep]
    n = np.bincount(doc, minlength=len(texts))
    off = np.concatenate([[0], np.cumsum(n)])
    zero = np.zeros(1, np.uint64)
    total = np.concatenate([zero, np.cumsum(mix(h), dtype=np.uint64)])
    other = np.concatenate([zero, np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    return Sets(doc, h, off, (total[off[1:]] - total[off[:-1]]).view(np.int64), (other[off[1:]] - other[off[:-1]]).view(np.int64))


def text_key(text_col):
    return F.xxhash64(text_col)


def _texts(docs: DataFrame, text_col: str, wanted: DataFrame, sim: Similarity) -> DataFrame:
    """(sid, text) of the wanted classes (sid, tkey, k1, k2): one text of each, written once."""
    wanted, n = materialize(wanted, "wanted", with_count=True)
    src = docs.select(text_key(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tkey"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    keys = wanted.select("tkey").distinct()
    found = src.join(F.broadcast(keys) if n <= BROADCAST_ROWS else keys, "tkey", "left_semi")
    one = found.groupBy("tkey").agg(F.first("text").alias("text"))
    texts = materialize(wanted.select("sid", "tkey").join(one, "tkey").select("sid", "text"), "texts")
    drop_frame(wanted)
    return texts


def _compared(pairs: DataFrame, texts: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b, na, nb, d, delta): sizes, size of the symmetric difference and, when it is the smaller part, its hashes."""
    left = pairs.select("a", "b").join(texts.select(F.col("sid").alias("a"), F.col("text").alias("ta")), "a")
    rows = left.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, np.empty(0, np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                s = sets_of(part.column(2).to_pylist(), sim)
                na, nb, d, delta = [], [], [], []
                for i, tb in enumerate(part.column(3).to_pylist()):
                    if tb != last:
                        last, other = tb, np.sort(sets_of([tb], sim).hash)
                    own = s.hash[s.off[i] : s.off[i + 1]]
                    diff = np.setxor1d(own, other, assume_unique=True)
                    na.append(len(own))
                    nb.append(len(other))
                    d.append(len(diff))
                    delta.append(diff.view(np.int64) if 2 * len(diff) <= len(own) + len(other) else None)
                cols = [part.column(0), part.column(1), *(pa.array(x, pa.int64()) for x in (na, nb, d)), pa.array(delta, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "na", "nb", "d", "delta"])

    return rows.mapInArrow(run, "a long, b long, na long, nb long, d long, delta array<long>")


def _links(d, total, sim: Similarity):
    """Whether sets of ``total`` elements together link, by the size of their symmetric difference."""
    return d * F.lit(sim.den + sim.num) <= total * F.lit(sim.den - sim.num)


# --- index lists -------------------------------------------------------------------------------


def _sorted_lists(entries: DataFrame, *order: str) -> DataFrame:
    return entries.repartitionByRange(*order).sortWithinPartitions(*order)


def _live_lists(entries: DataFrame, sim: Similarity, positional: bool) -> DataFrame:
    """(key, n, pos, sid, head) of the entries that may link to another one of their list.

    In size order an entry whose neighbours are too small and too large links to none; a list of two has one pair,
    whose positions tell too. Lists that may go on in another task are kept whole. ``head``: the first set of the
    list of similar size, else the set before; null for the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 4), np.int64)  # the last list so far: entries not yet let go
        head = None  # (sid, n) of the held list's first entry, when it was let go already
        first = True  # the task's first list, which may have begun in another task

        def let_go(rows: np.ndarray, edge_from: int, carried) -> pa.RecordBatch | None:
            """Rows of whole lists; ``edge_from``: index from which on lists are kept even if alone."""
            key, n, _, sid = rows.T
            new = np.concatenate([[carried is None], key[1:] != key[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            at = np.maximum(start, 0)
            h, hn = np.where(start < 0, carried[0] if carried else 0, sid[at]), np.where(start < 0, carried[1] if carried else 0, n[at])
            far = hn * sim.den < sim.num * n
            before, before_n = np.concatenate([sid[:1], sid[:-1]]), np.concatenate([n[:1], n[:-1]])
            h, hn = np.where(far, before, h), np.where(far, before_n, hn)
            none = new | (hn * sim.den < sim.num * n) | (h == sid)
            size = np.bincount(np.cumsum(new) - new[0])[np.cumsum(new) - new[0]] if len(key) else np.empty(0)
            pair = ~new[1:] & (n[:-1] * sim.den >= sim.num * n[1:])
            if positional:
                rest = np.minimum(n[:-1] - rows[:-1, 2], n[1:] - rows[1:, 2])
                pair &= (size[1:] > 2) | (rest * (sim.num + sim.den) >= (n[:-1] + n[1:]) * sim.num)
            near = np.append(pair, False) | np.append(False, pair)
            keep = near | (np.arange(len(key)) >= edge_from) | (start < 0)
            if not keep.any():
                return None
            cols = [pa.array(c[keep], pa.int64()) for c in (key, n, rows[:, 2], sid)]
            return pa.RecordBatch.from_arrays([*cols, pa.array(h[keep], pa.int64(), mask=none[keep])], names=["key", "n", "pos", "sid", "head"])

        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], 1)])
            if not len(rows):
                continue
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0], "left"))  # the last list may go on
            done, held = rows[:last], rows[last:]
            if len(done):
                stop = int(np.searchsorted(done[:, 0], done[0, 0], "right")) if first else 0
                for part, edge in ((done[:stop], 0), (done[stop:], len(done))):
                    if len(part) and (out := let_go(part, edge, head)) is not None:
                        yield out
                    if len(part):
                        head = None
                first = False
            if len(held) > BLOCK * 64:  # a long list is let go as it comes
                yield let_go(held, 0, head)
                head = head or (int(held[0, 3]), int(held[0, 1]))
                held = held[:0]
        if len(held):
            yield let_go(held, 0, head)

    return _sorted_lists(entries, "key", "n", "pos", "sid").mapInArrow(run, "key long, n long, pos long, sid long, head long")


def _heads(live: DataFrame, width: Column) -> DataFrame:
    """(sid, head): the head that most of a set's keys propose, at least an eighth of its ``width`` keys."""
    votes = live.where("head is not null").groupBy("sid", "head").agg(F.count(F.lit(1)).alias("v"), F.first("n").alias("n")).where(F.col("v") * 8 >= width)
    return votes.groupBy("sid").agg(F.max(F.struct("v", (-F.col("head")).alias("h"))).alias("m")).select("sid", (-F.col("m.h")).alias("head"))


def _neighbours(lists: DataFrame, turn: int, sim: Similarity) -> DataFrame:
    """Distinct (a, b) of different components that stand next to each other in a random order of a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.empty((0, 5), np.int64)
        for batch in batches:
            rows = np.concatenate([last, np.stack([c.to_numpy() for c in batch.columns], 1)])
            last = rows[-1:]
            x, y = rows[:-1], rows[1:]
            small, large = np.minimum(x[:, 2], y[:, 2]), np.maximum(x[:, 2], y[:, 2])
            ok = (x[:, 0] == y[:, 0]) & (x[:, 4] != y[:, 4]) & (small * sim.den >= large * sim.num)
            pair = np.unique(np.sort(np.stack([x[ok, 3], y[ok, 3]], 1), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0], pa.int64()), pa.array(pair[:, 1], pa.int64())], names=["a", "b"])

    mixed = lists.select("key", F.xxhash64(F.lit(turn), "sid").alias("at"), "n", "sid", "comp")
    return _sorted_lists(mixed, "key", "at").mapInArrow(run, "a long, b long").distinct()


_BLOCK_SCHEMA = "key long, part long, sids array<long>, ns array<long>, rests array<long>, comps array<long>, bits binary, n_lo long, n_hi long, rest_hi long, c_lo long, c_hi long"


def _blocks(entries: DataFrame, folded: int) -> DataFrame:
    """Blocks of the lists (key, n, pos, sid, comp, bits) of more than one component, or that may go on in another task."""
    kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 4 + [pa.binary()] + [pa.int64()] * 5
    names = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bits = np.empty((0, 5), np.int64), np.empty((0, folded // 8), np.uint8)
        whole = True  # keep the next list whatever its components: it may spread over tasks

        def blocks_of(rows: np.ndarray, bits: np.ndarray) -> list[tuple]:
            out = []
            for i in range(0, len(rows), BLOCK):
                r = rows[i : i + BLOCK]
                n, rest, c = r[:, 1], r[:, 1] - r[:, 2] - 1, r[:, 4]
                out.append((r[0, 0], i, r[:, 3], n, rest, c, bits[i : i + BLOCK].tobytes(), n.min(), n.max(), rest.max(), c.min(), c.max()))
            return out

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns[:5]], 1)])
            new = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(-1, folded // 8)
            bits = np.concatenate([held_bits, new])
            cuts = np.concatenate([[0], np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1])
            out: list[tuple] = []
            if len(cuts) > 1:
                lo, hi = np.minimum.reduceat(rows[:, 4], cuts)[:-1], np.maximum.reduceat(rows[:, 4], cuts)[:-1]
                for i in range(len(cuts) - 1):
                    if lo[i] != hi[i] or (whole and i == 0):
                        out += blocks_of(rows[cuts[i] : cuts[i + 1]], bits[cuts[i] : cuts[i + 1]])
                whole = False
            held, held_bits = rows[cuts[-1] :], bits[cuts[-1] :]
            if len(held) > BLOCK * 64:  # a long list is let go as it comes
                out += blocks_of(held, held_bits)
                held, held_bits, whole = held[:0], held_bits[:0], True
            if out:
                yield batch_of(out)
        if len(held):
            yield batch_of(blocks_of(held, held_bits))

    return _sorted_lists(entries.select("key", "n", "pos", "sid", "comp", "bits"), "key", "n", "pos", "sid").mapInArrow(run, _BLOCK_SCHEMA)


def _block_pairs(blocks: DataFrame, sim: Similarity, positional: bool, folded: int) -> DataFrame:
    """Distinct (a, b) of different components in one list that the bounds don't exclude."""
    numbered, n = materialize(blocks.withColumn("id", F.monotonically_increasing_id()), "blocks", with_count=True)
    # lists of one block that is alone hold only their own pairs; the join is on the key, larger sizes to the right
    l, r = numbered.alias("l"), numbered.alias("r")
    order = (F.struct("l.n_lo", "l.n_hi", "l.id") <= F.struct("r.n_lo", "r.n_hi", "r.id"))
    near = F.col("l.n_hi") * sim.den >= F.col("r.n_lo") * sim.num
    mixed = (F.least("l.c_lo", "r.c_lo") != F.greatest("l.c_hi", "r.c_hi"))
    cond = (F.col("l.key") == F.col("r.key")) & order & near & mixed
    if positional:
        cond &= (1 + F.least("l.rest_hi", "r.rest_hi")) * F.lit(sim.num + sim.den) >= (F.col("l.n_lo") + F.col("r.n_lo")) * sim.num
    pairs = l.join(r, cond).select(*(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "lr" for c in ("sids", "ns", "rests", "comps", "bits")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            col = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                sl, nl, rl, cl, sr, nr, rr, cr = (np.asarray(col[f"{s}_{c}"][i].values) for s in "lr" for c in ("sids", "ns", "rests", "comps"))
                small, large = np.minimum(nl[:, None], nr), np.maximum(nl[:, None], nr)
                ok = (cl[:, None] != cr) & (small * sim.den >= large * sim.num)
                if positional:
                    ok &= (1 + np.minimum(rl[:, None], rr)) * (sim.num + sim.den) >= (small + large) * sim.num
                x, y = np.nonzero(ok)
                bl, br = (np.frombuffer(col[f"{s}_bits"][i].as_py(), np.uint64).reshape(-1, folded // 64) for s in "lr")
                apart = np.bitwise_count(bl[x] ^ br[y]).sum(1, dtype=np.int64)
                near = apart * (sim.den + sim.num) <= (nl[x] + nr[y]) * (sim.den - sim.num)
                a.append(np.minimum(sl[x], sr[y])[near])
                b.append(np.maximum(sl[x], sr[y])[near])
            if a:
                pair = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0], pa.int64()), pa.array(pair[:, 1], pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


# --- classes and rows --------------------------------------------------------------------------


def classes_of(rows: DataFrame, id_col: str) -> DataFrame:
    """One written row per distinct non-empty set: a number, the least id, and what its members share."""
    one = rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min(id_col).alias("rep"), F.first("n").alias("n"), F.min("tkey").alias("tkey"), F.first("parity").alias("parity"), F.first("keys").alias("keys")
    )
    return materialize(one.withColumn("sid", F.monotonically_increasing_id()), "classes")


def rows_and_classes(rows: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, n, k1, k2) of each row, and the classes; the rows' index keys are written once and deleted when the classes hold them."""
    wide = materialize(rows, "sets")
    classes = classes_of(wide, id_col)
    lean = materialize(wide.select(id_col, "n", "k1", "k2"), "set-keys")
    drop_frame(wide)
    return lean, classes


def named(rows: DataFrame, grouped: DataFrame, id_col: str) -> DataFrame:
    """Each row with the least id of its class's component."""
    grouped = grouped.select("k1", "k2", "rep", "component")
    least = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = grouped.join(least, "component").select("k1", "k2", "component_id")
    out = rows.select(id_col, F.col("n").alias("n_shingles"), "k1", "k2").join(by_set, ["k1", "k2"], "left")
    return out.select(id_col, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col)).alias("component_id"))


# --- the whole ---------------------------------------------------------------------------------


def _bitmaps_near(sim: Similarity):
    """Whether two bitmaps allow a link; sizes na and nb."""

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series, total: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(map(bytes, v)), np.uint64).reshape(-1, PARITY // 64) for v in (x, y))
        apart = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
        return pd.Series(apart * (sim.den + sim.num) <= total.to_numpy() * (sim.den - sim.num))

    return near


def _folded(parity: str, folded: int) -> Column:
    """Bitmaps of ``folded`` bits; a folded bit is the parity of the bits it stands for."""
    if folded == PARITY:
        return F.col(parity)

    @F.pandas_udf(T.BinaryType())
    def fold(parity: pd.Series) -> pd.Series:
        rows = np.frombuffer(b"".join(map(bytes, parity)), np.uint8).reshape(-1, PARITY // folded, folded // 8)
        return pd.Series([r.tobytes() for r in np.bitwise_xor.reduce(rows, axis=1)])

    return fold(parity)


class _Answers:
    """What is known of the classes when pairs are decided: heads, differences to them, sizes, bitmaps."""

    def __init__(self, classes: DataFrame, docs: DataFrame, text_col: str, sim: Similarity, star: DataFrame):
        self.classes, self.docs, self.text_col, self.sim = classes, docs, text_col, sim
        own = star.where("delta is not null").select(F.col("a").alias("sid"), F.col("b").alias("head"), "delta")
        as_head = star.where("delta is not null").select(F.col("b").alias("sid")).distinct().join(own.select("sid"), "sid", "left_anti")
        heads = own.unionByName(as_head.select("sid", F.col("sid").alias("head"), F.array().cast("array<long>").alias("delta")))
        sizes = classes.select("sid", F.col("n").cast("long").alias("n"), "parity")
        self.known = sizes.join(heads, "sid", "left")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The (a, b) of ``pairs`` that link."""
        sim, k = self.sim, self.known
        pairs, n = materialize(pairs, "pairs", with_count=True)
        if not n:
            return pairs
        left = pairs.join(k.select(*(F.col(c).alias(f"{c}_a") for c in k.columns)), F.col("a") == F.col("sid_a"))
        both = left.join(k.select(*(F.col(c).alias(f"{c}_b") for c in k.columns)), F.col("b") == F.col("sid_b"))
        total = F.col("n_a") + F.col("n_b")
        one_head = F.coalesce(F.col("head_a") == F.col("head_b"), F.lit(False))
        d = (F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))).cast("long")
        near = both.where(_bitmaps_near(sim)("parity_a", "parity_b", total))
        seen = materialize(near.select("a", "b", F.when(one_head, _links(d, total, sim)).alias("link")), "decided")
        left_open = seen.where("link is null").select("a", "b")
        ids = left_open.select(F.col("a").alias("sid")).unionByName(left_open.select(F.col("b").alias("sid"))).distinct()
        texts = _texts(self.docs, self.text_col, self.classes.join(ids, "sid", "left_semi").select("sid", "tkey"), sim)
        slow = _compared(left_open, texts, sim).where(_links(F.col("d"), F.col("na") + F.col("nb"), sim)).select("a", "b")
        links = materialize(seen.where("link").select("a", "b").unionByName(slow), "links")
        for done in (pairs, seen, texts):
            drop_frame(done)
        return links


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (sid, comp) after ``links`` have joined components."""
    across = links.join(comp.select(F.col("sid").alias("a"), F.col("comp").alias("ca")), "a").join(comp.select(F.col("sid").alias("b"), F.col("comp").alias("cb")), "b")
    if links.isEmpty():
        return comp
    joined = components(across.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    new = comp.join(joined.select(F.col("node").alias("comp"), "component"), "comp", "left")
    merged = materialize(new.select("sid", F.coalesce("component", "comp").alias("comp")), "comps")
    drop_frame(links)
    drop_frame(comp)
    return merged


def with_components(classes: DataFrame, docs: DataFrame, text_col: str, sim: Similarity, positional: bool, rounds: int = ROUNDS, folded: int = FOLDED) -> DataFrame:
    """``classes`` (sid, k1, k2, n, tkey, parity, keys) with ``component``: the least sid that links reach.

    What is written on the way is deleted as soon as nothing reads it: ``classes`` too, once its keys are in lists.
    ``rounds`` of neighbour proposals come before the blocks, whose bitmaps have ``folded`` bits: more of either leave
    fewer pairs to compare. They steer work, never results."""
    ship_package(classes.sparkSession)
    older = scratch_made()
    able = classes.where(F.col("n") >= sim.least_size)
    entries = able.select(F.posexplode("keys").alias("pos", "key"), F.col("n").cast("long").alias("n"), "sid").select("key", "n", F.col("pos").cast("long").alias("pos"), "sid")
    live, n = materialize(_live_lists(entries, sim, positional), "live", with_count=True)
    lean = materialize(classes.drop("keys"), "class-facts")
    drop_frame(classes)
    classes = lean
    if not n:
        return classes.withColumn("component", F.col("sid"))
    width = F.col("n") - F.ceil(F.col("n") * sim.num / sim.den) + 1 if positional else F.lit(8)
    heads = materialize(_heads(live, width), "heads")
    ids = heads.select("sid").unionByName(heads.select(F.col("head").alias("sid"))).distinct()
    texts = _texts(docs, text_col, classes.join(ids, "sid", "left_semi").select("sid", "tkey"), sim)
    star = materialize(_compared(heads.select(F.col("sid").alias("a"), F.col("head").alias("b")), texts, sim), "stars")
    drop_frame(texts)
    drop_frame(heads)
    answers = _Answers(classes.select("sid", "n", "tkey", "parity"), docs, text_col, sim, star)
    comp = materialize(live.select("sid").distinct().withColumn("comp", F.col("sid")), "comps")
    comp = _merged(comp, star.where(_links(F.col("d"), F.col("na") + F.col("nb"), sim)).select("a", "b"))
    for turn in range(rounds):
        comp = _merged(comp, answers.links(_neighbours(live.join(comp, "sid"), turn, sim)))
    lists = live.join(comp, "sid").join(classes.select("sid", _folded("parity", folded).alias("bits")), "sid")
    comp = _merged(comp, answers.links(_block_pairs(_blocks(lists, folded), sim, positional, folded)))
    drop_scratch(comp.sparkSession, [p for p in scratch_made() if p not in (*older, lean.scratch_path, comp.scratch_path)])
    return classes.join(comp, "sid", "left").withColumn("component", F.coalesce("comp", "sid")).drop("comp")
