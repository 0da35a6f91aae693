import random
import re
from collections import Counter

import duckdb
import pytest

from voltline.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, cfg):
    """Rows (lang, source, text); plain loops over terms."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        n, seen = {}, Counter()
        for _, source, text in (r for r in rows if r[0] == lang):
            terms = TERM.findall(text.translate(LOWER))
            n.setdefault(source, Counter()).update(terms)
            seen.update(set(terms))
        keep = [t for t, k in seen.items() if k >= cfg.least_docs]
        freq = lambda c: {t: 1 + cfg.scale * (c[t] + 2) // (sum(c[k] for k in keep) + 2 * len(keep)) for t in keep}
        p, q = {s: freq(c) for s, c in n.items()}, freq(sum(n.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in n:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in keep)) for o in n if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in keep if n[s][t] and p[s][t] > q[t]]
            for part, got, most in (("pair", pairs, None), ("term", terms, cfg.top)):
                ranked = sorted(got, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def random_rows(n=400, seed=2):
    rng = random.Random(seed)
    words = [f"{c}{d}" for c in "abcéß漢" for d in "abcdefghijklmno"] + ["AB", "x-y", "😀", "a1b"]
    return [(rng.choice(["en", "fr", None, "xx"]), rng.choice([f"s{k}" for k in range(9)] + [None, ""]),
             rng.choice([None, "", " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.choice([0, 3, 60])))])) for _ in range(n)] + [("alone", "s", "one"), ("alone", "t", None)]


@pytest.mark.parametrize("cfg", [D.AuditConfig(), D.AuditConfig(least_docs=3, top=4, held_terms=20, block_rows=50, tile=2)])
def test_against_plain_loops(spark, cfg):
    rows = random_rows()
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, value long").repartition(5)
    assert sorted(map(tuple, D.divergence(docs, cfg=cfg).collect())) == brute(rows, cfg)


def test_a_hot_source_and_many_sources(spark):
    rng = random.Random(9)
    rows = [("en", "hot" if i % 3 == 0 else f"s{i % 70}", " ".join(f"w{'abcdefghij'[min(9, int(rng.expovariate(0.4)))]}{'xyz'[i % 3]}" for _ in range(30))) for i in range(1500)]
    cfg = D.AuditConfig(least_docs=2, block_rows=300, tile=16)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, D.divergence(docs, cfg=cfg).collect())) == brute(rows, cfg)


def test_odd_rows(spark, odd_docs, no_docs):
    cfg = D.AuditConfig(least_docs=1)
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, D.divergence(odd_docs, cfg=cfg).collect())) == brute(rows, cfg)
    assert D.divergence(no_docs).count() == 0


def test_slices_of_long_texts_end_between_terms(monkeypatch):
    monkeypatch.setattr(D, "_SLICE", 50)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "é", "漢", " ", ".", "x" * 70]) for _ in range(rng.choice([0, 20, 200])))
        assert [t.decode() for part in D.term_slices(text.encode()) for t in part] == TERM.findall(text.translate(LOWER))


def test_bitset_sums_of_one_block():
    rows = lambda s, total, sets: [dict(source=s, total_n=total, lang_terms=70, count=c, words=w, bits=b) for c, w, b in [(None, None, None), *sets]]
    tile = D.tile_of(rows("a", 9, [(1, [0, 1], [5, 1]), (7, [0], [2])]) + rows("b", 3, [(3, [1], [1])]) + rows("c", 0, []), 70, 1000)
    count = {"a": {0: 1, 2: 1, 64: 1, 1: 7}, "b": {64: 3}, "c": {}}
    p = lambda s, t: 1 + 1000 * (count[s].get(t, 0) + 2) // ({"a": 9, "b": 3, "c": 0}[s] + 140)
    want = [[sum((p(x, t) - p(y, t)) ** 2 // (p(x, t) + p(y, t)) for t in range(70)) for y in "abc"] for x in "abc"]
    assert D.pair_sums(tile, tile).tolist() == want


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    cur = con.execute(D.oracle())
    rows = D.op11_source_divergence(spark, "/root/testdata/sf0.001")
    assert [c[0] for c in cur.description] == rows.columns
    assert sorted(map(tuple, rows.collect())) == sorted(cur.fetchall())
