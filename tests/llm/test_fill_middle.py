import hashlib
import random

import duckdb
import numpy as np
import pytest

from voltline.llm import fill_middle as M


def test_select_over_arrays_bitmaps_and_runs():
    rng = np.random.default_rng(5)
    sets = [
        np.arange(200_000), np.arange(0, 400_000, 2), np.sort(rng.choice(1 << 20, 3000, replace=False)),
        np.sort(rng.choice(1 << 18, 150_000, replace=False)), np.array([0]), np.array([65535, 65536, 65537, 1 << 40]),
        np.concatenate([np.arange(10, 5000), np.arange(70_000, 70_005), np.arange(140_000, 140_000 + 60_000, 3)]),
    ]
    kinds = set()
    for offsets in sets:
        s = M.BoundarySet(offsets)
        kinds |= {type(c).__name__ for c in s.containers}
        for k in {0, len(offsets) - 1, *rng.integers(0, len(offsets), 300).tolist()}:
            assert s.select(k) == offsets[k]
        with pytest.raises(IndexError):
            s.select(len(offsets))
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}
    assert M.BoundarySet(np.empty(0)).size == 0


def test_units():
    text = "  ab ç\n\nde"
    data = text.encode()
    places = lambda u: [s.select(k) for s in [M.boundaries(data, u)] for k in range(s.size)]
    assert places("char") == [len(text[:i].encode()) for i in range(len(text) + 1)]
    assert places("word") == [0, 5, 9, 11] and places("line") == [0, 8, 9, 11]
    for unit in ("char", "word", "line"):
        assert M.boundaries(b"", unit).size == 1
    with pytest.raises(ValueError):
        M.boundaries(b"a", "page")


def brute(doc_id, t):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(t)
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return n, "plain", None, None, t
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}")


def test_random_texts_against_slices_and_back():
    rng = random.Random(3)
    for i in range(3000):
        t = "".join(rng.choice("ab <PSM>\né漢😀") for _ in range(rng.choice([0, 1, 2, 5, 60])))
        i = rng.choice([i, -i, None])
        n, form, a, m, out = M.transform(i, t.encode())
        assert (n, form, a, m, out.decode()) == brute(i, t)
        assert M.restore(out, form).decode() == t
        for unit in ("word", "line"):
            cfg = M.MiddleConfig(unit=unit)
            *_, form, _, _, out = M.transform(i, t.encode(), cfg)
            assert M.restore(out, form, cfg).decode() == t


def test_odd_rows_and_long_text(spark, odd_docs, no_docs):
    got = sorted((str(r.doc_id), r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in M.fill_in_middle(odd_docs).collect())
    assert got == sorted((str(r.doc_id), *brute(r.doc_id, r.text or "")) for r in odd_docs.select("doc_id", "text").collect())
    assert M.fill_in_middle(no_docs).count() == 0
    long = "é漢a " * 300_000
    n, form, a, m, out = M.transform(8, long.encode())
    assert (n, form, a, m, out.decode()) == brute(8, long)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    cur = con.execute(M.oracle())
    rows = M.op12_fill_in_middle(spark, "/root/testdata/sf0.001")
    assert [c[0] for c in cur.description] == rows.columns
    got = sorted(map(tuple, rows.collect()))
    assert got == sorted(cur.fetchall()) and {r[2] for r in got} == {"plain", "psm", "spm"}
