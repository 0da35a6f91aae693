"""Source divergence audit: how far the term frequencies of the sources of a language lie apart, and by which terms.

For two smoothed, rounded frequencies p and q of a term, f = floor((p - q)^2 / (p + q)); a pair of sources has the sum
of f over all kept terms of their language. A source's p depends on the term's count alone, so the sum runs over joint
cells of counts: for each (source, count) a bitset of term ids is stored, the AND of two bitsets and its popcount are
the cell's number of terms, multiplied once by f. Count 0 is the complement of a source's bitsets and is not stored.

Terms are counted per task before they move, and move once, by (language, term). They are dealt into blocks of about
``block_rows`` (term, source) rows of similar frequency, so that a block holds few counts; ids are given in a block,
64 to a word of a bitset. A task joins the bitsets of two tiles of about ``tile`` sources in one block and emits sums,
one row per pair of sources. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltline.llm.common import table
from voltline.session import materialize, ship_package


@dataclass(frozen=True)
class AuditConfig:
    least_docs: int = 10  # a kept term is in so many documents of its language
    top: int = 10  # ranks of the terms of a source
    scale: int = 1_000_000_000
    held_terms: int = 200_000  # distinct (source, term) counts that a task holds before it emits them
    block_rows: int = 100_000
    tile: int = 32


#: Bytes of a term: ASCII letters (A-Z lower-cased) and all bytes of characters beyond ASCII; others part terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SLICE = 1 << 20
#: Rows of (language, tier) that go to every task; more are joined by a shuffle.
BROADCAST_TIERS = 100_000


def term_slices(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in lists of bounded size; a slice ends between terms."""
    if len(data) <= _SLICE:
        yield data.translate(_TERM_BYTES).split()
        return
    start = 0
    while start < len(data):
        part = data[start : start + _SLICE].translate(_TERM_BYTES)
        cut = len(part) if start + _SLICE >= len(data) else part.rfind(b" ") + 1
        if not cut:  # one term is longer than the slice: up to its end
            rest = data[start:].translate(_TERM_BYTES)
            cut = rest.find(b" ") + 1 or len(rest)
            part = rest
        yield part[:cut].split()
        start += cut


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str, cfg: AuditConfig) -> DataFrame:
    """Partial counts (lang, source, term, n, docs) of each task; a row of the empty term for every group it met."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))], text.alias("text"))
    names = ["lang", "source", "term", "n", "docs"]

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, seen) in held.items():
            terms = [b"", *n]
            cols = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()),
                    pa.array([0, *n.values()], pa.int64()), pa.array([0, *[seen[t] for t in n]], pa.int64())]
            yield from pa.Table.from_arrays(cols, names=names).to_batches(20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i, key in enumerate(zip(langs, sources)):
                n, seen = held.setdefault(key, (Counter(), Counter()))
                before, here = len(n), set()
                for terms in term_slices(texts[i].as_py()):
                    n.update(terms)
                    here.update(terms)
                seen.update(here)
                size += len(n) - before
                if size > cfg.held_terms:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return src.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def kept_terms(partial: DataFrame, cfg: AuditConfig) -> DataFrame:
    """(lang, source, term, n, total, first) of kept terms, one exchange; groups themselves as rows of the empty term.

    ``total``: the term's count in the language; ``first`` marks one row of each (lang, term)."""
    whole = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    stats = whole.select("*", F.sum("docs").over(w).alias("in_docs"), F.sum("n").over(w).alias("total"), (F.min("source").over(w) == F.col("source")).alias("first"))
    return stats.where((F.length("term") == 0) | (F.col("in_docs") >= cfg.least_docs)).select("lang", "source", "term", "n", "total", "first")


def group_sizes(kept: DataFrame) -> DataFrame:
    """(lang, source, total_n, lang_n, lang_terms) of every group, also one without kept terms."""
    per = kept.groupBy("lang", "source").agg(F.sum("n").alias("total_n"), F.count_if((F.length("term") > 0) & F.col("first")).alias("firsts"))
    w = Window.partitionBy("lang")
    return per.select("lang", "source", "total_n", F.sum("total_n").over(w).alias("lang_n"), F.sum("firsts").over(w).alias("lang_terms"))


def frequency(count: str, total: str, terms: str, scale: int) -> str:
    """SQL of 1 + floor(scale * (count + 2) / (total + 2 * terms)), exact whatever the counts."""
    return f"cast((cast({count} + 2 as decimal(20,0)) * {scale}) div cast({total} + 2 * {terms} as decimal(20,0)) as bigint) + 1"


_F = "((p - q) * (p - q)) div (p + q)"


def top_terms(kept: DataFrame, sizes: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Terms more frequent in a source than in its language, by f; the ranks are cut in each task before rows move."""
    rows = kept.where("length(term) > 0 and n > 0").join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", F.expr(frequency("n", "total_n", "lang_terms", cfg.scale)).alias("p"), F.expr(frequency("total", "lang_n", "lang_terms", cfg.scale)).alias("q"))
    rows = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_F).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.top)


def count_bitsets(kept: DataFrame, cfg: AuditConfig) -> DataFrame:
    """(lang, block, terms, source, count, words, bits): the term-id bitset of each (source, count) in each block.

    Ids follow the terms' frequency within a block; ``words`` are the numbers of the words that aren't zero, ``bits``
    the words; ``terms`` is the number of ids of the block."""
    rows = kept.where("length(term) > 0").withColumn("tier", F.length(F.bin("total")))
    per = rows.groupBy("lang", "tier").agg(F.ceil(F.count(F.lit(1)) / cfg.block_rows).alias("slots"))
    per, n_tiers = materialize(per, "audit-tiers", with_count=True)  # at most 64 rows a language
    per = F.broadcast(per) if n_tiers <= BROADCAST_TIERS else per
    rows = rows.join(per, ["lang", "tier"]).withColumn("slot", F.expr("pmod(xxhash64(term), slots)")).select("lang", "tier", "slot", "term", "source", "n", "total")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("total", "ascending"), ("term", "ascending")])
        term = group.column("term").combine_chunks()
        new = np.ones(len(term), bool)
        if len(term) > 1:
            new[1:] = pa.compute.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
        ids = np.cumsum(new) - 1
        source = group.column("source").combine_chunks().dictionary_encode()
        who, n = source.indices.to_numpy(), group.column("n").to_numpy()
        order = np.lexsort((ids, n, who))
        who, n, ids = who[order], n[order], ids[order]
        word, bit = ids >> 6, np.uint64(1) << (ids & 63).astype(np.uint64)
        cell = np.flatnonzero((np.diff(who, prepend=-1) != 0) | (np.diff(n, prepend=-1) != 0))
        edge = np.unique(np.concatenate([cell, np.flatnonzero(np.diff(word, prepend=-1) != 0)]))
        words, bits = word[edge], np.bitwise_or.reduceat(bit, edge).view(np.int64)
        cuts = pa.array(np.append(np.searchsorted(edge, cell), len(edge)), pa.int32())
        m = len(cell)
        const = lambda c: pa.array([group.column(c)[0].as_py()] * m, group.schema.field(c).type)
        return pa.Table.from_arrays(
            [const("lang"), const("tier"), const("slot"), pa.array([int(ids.max()) + 1] * m, pa.int32()), source.dictionary.take(pa.array(who[cell])), pa.array(n[cell]),
             pa.ListArray.from_arrays(cuts, pa.array(words, pa.int32())), pa.ListArray.from_arrays(cuts, pa.array(bits, pa.int64()))],
            names=["lang", "tier", "slot", "terms", "source", "count", "words", "bits"])

    return rows.groupBy("lang", "tier", "slot").applyInArrow(run, "lang string, tier int, slot long, terms int, source string, count long, words array<int>, bits array<long>")


@dataclass
class Tile:
    """The bitset words of some sources in one block, by word; the complement of a source's bits stands as count 0."""

    sources: list[str]
    start: np.ndarray  # first entry of each word, then the number of entries
    who: np.ndarray
    p: np.ndarray
    bits: np.ndarray


def tile_of(rows: list[dict], terms: int, scale: int) -> Tile:
    """``rows``: source, total_n, lang_terms and (count, words, bits), or a null count for the source's own row."""
    sources = sorted({r["source"] for r in rows})
    at = {s: i for i, s in enumerate(sources)}
    sizes = {at[r["source"]]: (r["total_n"] + 2 * r["lang_terms"]) for r in rows}
    p_of = lambda i, count: 1 + scale * (count + 2) // sizes[i]
    n_words = (terms + 63) >> 6
    valid = np.full(n_words, ~np.uint64(0))
    if terms & 63:
        valid[-1] = (np.uint64(1) << np.uint64(terms & 63)) - np.uint64(1)
    rest = np.repeat(valid[None], len(sources), 0)
    parts = [(np.arange(n_words), np.full(n_words, i), np.full(n_words, p_of(i, 0))) for i in range(len(sources))]
    bits = []
    for r in rows:
        if r["count"] is not None:
            i, w, b = at[r["source"]], np.asarray(r["words"], np.int64), np.asarray(r["bits"], np.int64).view(np.uint64)
            rest[i, w] &= ~b  # a source's bitsets of different counts are disjoint
            parts.append((w, np.full(len(w), i), np.full(len(w), p_of(i, r["count"]))))
            bits.append(b)
    word, who, p = (np.concatenate(x) for x in zip(*parts))
    bits = np.concatenate([rest.ravel(), *bits])
    some = np.flatnonzero(bits)
    some = some[np.lexsort((who[some], word[some]))]
    return Tile(sources, np.searchsorted(word[some], np.arange(n_words + 1)), who[some], p[some].astype(np.int64), bits[some])


def pair_sums(a: Tile, b: Tile) -> np.ndarray:
    """Sum of f over the block's terms for each source of ``a`` and ``b``: popcounts of ANDs times f of the two counts."""
    out = np.zeros((len(a.sources), len(b.sources)), np.int64)
    for w in range(len(a.start) - 1):
        x, y = slice(a.start[w], a.start[w + 1]), slice(b.start[w], b.start[w + 1])
        cell = np.bitwise_count(a.bits[x][:, None] & b.bits[y][None, :])
        i, j = np.nonzero(cell)
        p, q = a.p[x][i], b.p[y][j]
        value = cell[i, j].astype(np.int64) * ((p - q) * (p - q) // (p + q))
        np.add.at(out, (a.who[x][i], b.who[y][j]), value)
    return out


def source_pairs(bitsets: DataFrame, sizes: DataFrame, cfg: AuditConfig) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language; 0 where the language keeps no term."""
    own = F.expr("pmod(xxhash64(source), tiles)")
    tiled = sizes.withColumn("tiles", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / cfg.tile)).withColumn("tile", own).select("lang", "source", "total_n", "lang_terms", "tiles", "tile")
    blocks = bitsets.select("lang", "tier", "slot", "terms").distinct()
    none = [F.lit(None).cast(t).alias(c) for c, t in (("count", "long"), ("words", "array<int>"), ("bits", "array<long>"))]
    rows = bitsets.unionByName(blocks.join(tiled.select("lang", "source"), "lang").select("*", *none)).join(tiled, ["lang", "source"])
    # a source's rows go to each pair of tiles that holds its own, the lesser tile first
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = other.withColumn("t1", F.least("tile", "other")).withColumn("t2", F.greatest("tile", "other"))
    dealt = dealt.select("lang", "tier", "slot", "t1", "t2", "tile", "terms", "source", "total_n", "lang_terms", "count", "words", "bits")
    scale = cfg.scale
    empty = pa.table({"lang": pa.array([], pa.string()), "one": pa.array([], pa.string()), "two": pa.array([], pa.string()), "value": pa.array([], pa.int64())})

    def run(group: pa.Table) -> pa.Table:
        t1, t2, lang, terms = (group.column(c)[0].as_py() for c in ("t1", "t2", "lang", "terms"))
        rows = group.select(["tile", "source", "total_n", "lang_terms", "count", "words", "bits"]).to_pylist()
        sides = [[r for r in rows if r["tile"] == t] for t in (t1, t2)]
        if not sides[0] or not sides[1]:  # a tile without a source
            return empty
        a = tile_of(sides[0], terms, scale)
        b = a if t1 == t2 else tile_of(sides[1], terms, scale)
        sums = pair_sums(a, b)
        i, j = np.triu_indices(len(a.sources), 1) if t1 == t2 else map(np.ravel, np.indices(sums.shape))
        names = [[t.sources[k] for k in at.tolist()] for t, at in ((a, i), (b, j))]
        return pa.Table.from_arrays([pa.array([lang] * len(i), pa.string()), *[pa.array(x, pa.string()) for x in names], pa.array(sums[i, j], pa.int64())], names=["lang", "one", "two", "value"])

    summed = dealt.groupBy("lang", "tier", "slot", "t1", "t2").applyInArrow(run, "lang string, one string, two string, value long").groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    ways = F.inline(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    both = summed.select("lang", "value", ways)
    # languages without a kept term have no block: each pair of theirs is 0
    bare = sizes.where("lang_terms = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return both.select("lang", "source", "item", "value").unionByName(zero.select("lang", "source", "item", "value"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language every other one (`pair`) and its leading terms (`term`).

    Null text, lang and source count as ''. Groups without a term, and languages that keep none, have their pairs all
    the same. Ties rank by the item's bytes; a repeated row counts each time; a text of any length is read whole, in
    slices; an empty table gives no rows. Other columns are not read.
    """
    kept = materialize(kept_terms(term_counts(docs, lang_col, source_col, text_col, cfg), cfg), "audit-terms")
    sizes = materialize(group_sizes(kept), "audit-groups")
    bitsets = materialize(count_bitsets(kept, cfg), "audit-bitsets")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = source_pairs(bitsets, sizes, cfg).withColumn("rank", F.row_number().over(order))
    parts = [rows.select("lang", "source", F.lit(part).alias("part"), F.col("item").cast("string").alias("item"), "value", F.col("rank").cast("int").alias("rank"))
             for part, rows in (("pair", pairs), ("term", top_terms(kept, sizes, cfg)))]
    return parts[0].unionByName(parts[1])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` with the contract's parameters: terms in 10 documents, ten ranks of terms, all ranks of pairs."""
    return divergence(table(spark, sf_dir, "documents"))


def oracle(cfg: AuditConfig = AuditConfig()) -> str:
    """DuckDB SQL of ``op11_source_divergence``: each kept term of each group by itself, no bitsets."""
    over = "OVER (PARTITION BY lang, source)"
    freq = lambda n, o: f"1 + ({cfg.scale}::HUGEINT * ({n} + 2)) // (sum({n}) {o} + 2 * count(*) {o})"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
     g AS (SELECT DISTINCT lang, source FROM d),
     t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {cfg.least_docs}),
     c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
     a AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     p AS (SELECT lang, source, term, n, {freq("n", over)} AS p, {freq("total", over)} AS q FROM a),
     x AS (SELECT one.lang, one.source, two.source AS item, sum((one.p - two.p) * (one.p - two.p) // (one.p + two.p)) AS value
           FROM p one JOIN p two ON one.lang = two.lang AND one.term = two.term AND one.source <> two.source GROUP BY ALL),
     pairs AS (SELECT one.lang, one.source, two.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
               FROM g one JOIN g two ON one.lang = two.lang AND one.source <> two.source LEFT JOIN x ON x.lang = one.lang AND x.source = one.source AND x.item = two.source),
     terms AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
     ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
                UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {cfg.top}"""
