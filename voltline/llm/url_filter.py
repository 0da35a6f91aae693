"""URL filter: longest matching host/path rule, else a weighted vocabulary counted with Aho-Corasick.

The automaton holds strict and soft terms; a hit counts when no ASCII letter or digit stands directly before or
after it. One strict hit rejects the url, and so do several distinct soft terms whose weights together reach the
vocabulary's limit. A vocabulary is a value: the default one, one built from terms, or one read from a table. It ships
with the tasks, as the rules do; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltline.llm.common import table
from voltline.session import ship_package

#: (verdict, host, path), fixed by the query's contract.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
STRICT = ("adult", "casino", "escort", "gambling", "malware", "pills", "porn", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bets", "bonus", "cheap", "click", "farm", "free", "hot", "loan", "promo", "track", "win")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = str.maketrans(_UPPER, _LOWER)
_INNER = frozenset(_LOWER + "0123456789")
#: Terms that a vocabulary read from a table may hold: it is kept by every task.
VOCABULARY_ROWS = 1_000_000


@dataclass(frozen=True)
class Vocabulary:
    """Strict terms; soft terms with weights; how many distinct soft terms, of which weight together, reject a url."""

    strict: tuple[str, ...] = STRICT
    soft: tuple[tuple[str, float], ...] = tuple((t, 1.0) for t in SOFT)
    least_distinct: int = 2
    least_weight: float = 2.0

    @classmethod
    def of(cls, strict: Iterable[str], soft: Mapping[str, float], **limits) -> Vocabulary:
        """Terms are lower-cased (A-Z); empty ones are left out; a term that is both is strict."""
        hard = {t.translate(_ASCII_LOWER) for t in strict if t}
        mild = {t.translate(_ASCII_LOWER): float(w) for t, w in soft.items() if t}
        return cls(tuple(sorted(hard)), tuple(sorted((t, w) for t, w in mild.items() if t not in hard)), **limits)

    @classmethod
    def read(cls, terms: DataFrame, **limits) -> Vocabulary:
        """From a table (term, kind, weight): kind ``strict`` or ``soft``; a null weight is 1; of repeated soft terms the greatest weight counts."""
        kept = terms.where("term IS NOT NULL AND kind IN ('strict', 'soft')").groupBy("term", "kind").agg(F.max(F.coalesce(F.col("weight").cast("double"), F.lit(1.0))).alias("weight"))
        rows = kept.orderBy("term", "kind").limit(VOCABULARY_ROWS + 1).collect()
        if len(rows) > VOCABULARY_ROWS:
            raise ValueError(f"a vocabulary holds at most {VOCABULARY_ROWS} terms")
        return cls.of([r["term"] for r in rows if r["kind"] == "strict"], {r["term"]: r["weight"] for r in rows if r["kind"] == "soft"}, **limits)


DEFAULT = Vocabulary()


@cache
def automaton(words: Vocabulary):
    a = ahocorasick.Automaton()
    for t in words.strict:
        a.add_word(t, (0, t, 0.0))
    for t, w in words.soft:
        a.add_word(t, (1, t, w))
    a.make_automaton()
    return a


def hits(url: str | None, words: Vocabulary = DEFAULT) -> tuple[int, int, float]:
    """(strict hits, distinct soft terms, their weight) of a url; null has none."""
    if not url or not (words.strict or words.soft):
        return 0, 0, 0.0
    u, n, seen = url.translate(_ASCII_LOWER), 0, {}
    for end, (kind, term, weight) in automaton(words).iter(u):
        start = end - len(term) + 1
        if (start and u[start - 1] in _INNER) or (end + 1 < len(u) and u[end + 1] in _INNER):
            continue
        if kind == 0:
            n += 1
        else:
            seen[term] = weight
    return n, len(seen), sum(seen[t] for t in sorted(seen))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): empty without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, pattern, 1), _UPPER, _LOWER), F.regexp_extract(u, pattern, 2)


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, words: Vocabulary = DEFAULT) -> DataFrame:
    """One row per input row. A null url, or one without ``://``, has an empty host and path and no rule; the
    vocabulary is matched over the whole url, of any length. Repeated rows give repeated rows; an empty table gives
    none; other columns are not read."""
    ship_package(pages.sparkSession)
    src = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"))
    names = [id_col, "_url", "n_strict", "n_soft", "soft_weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [hits(u, words) for u in b.column(1).to_pylist()]
            cols = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=names)

    counted = src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, _url string, n_strict long, n_soft long, soft_weight double")
    host, path = url_parts(F.col("_url"))
    parts = counted.select(id_col, host.alias("host"), path.alias("path"), "n_strict", "n_soft", "soft_weight")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rejects = (F.col("n_strict") > 0) | ((F.col("n_soft") >= words.least_distinct) & (F.col("soft_weight") >= words.least_weight))
    own = F.when(rejects, "block").otherwise("allow")
    return parts.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "n_strict", "n_soft", "soft_weight")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url_verdicts`` of every url of ``pages`` by the contract's rules and the default vocabulary."""
    return url_verdicts(table(spark, sf_dir, "pages")).drop("n_strict")


def oracle() -> str:
    """DuckDB SQL of ``op6_url_filter``; each term is a pattern of its own."""
    def hit(t: str) -> str:
        return f"CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS BIGINT)"

    fits = [(v, h, p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for _, h, p, f in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for v, _, _, f in fits) + " END"
    total = lambda terms: " + ".join(f"{w} * {hit(t)}" for t, w in terms)
    low = lambda x: f"translate({x}, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH p AS (SELECT page_id, {low("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path, {low("coalesce(url, '')")} AS u FROM pages),
     m AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled, {total((t, 1) for t in DEFAULT.strict)} AS n_strict, {total((t, 1) for t, _ in DEFAULT.soft)} AS n_soft,
                  CAST({total(DEFAULT.soft)} AS DOUBLE) AS soft_weight FROM p)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN n_strict > 0 OR (n_soft >= {DEFAULT.least_distinct} AND soft_weight >= {DEFAULT.least_weight}) THEN 'block' ELSE 'allow' END) AS verdict,
       n_soft, soft_weight FROM m"""
