import hashlib
import re

import numpy as np

from test_set_join import brute, near_copies as near_texts

from voltline.llm import fingerprints as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CFG = P.MinHashConfig()


def shingle_set(t):
    w = WORD.findall(t)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return np.mean([a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)])


def expected(rows, got):
    """Holds each result against its text and the next document's."""
    error = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        g = got[d]
        one, two, nxt = P._hex(P._short(P.signatures([t, edited, after], CFG)))
        assert (g.n_chars, g.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (g.fingerprint, g.edited_fingerprint) == (one, two)
        assert g.near_edited == likeness(one, two) and g.near_next == likeness(one, nxt)
        a, b = shingle_set(t), shingle_set(edited)
        error.append(g.near_edited - (len(a & b) / len(a | b) if a | b else 1))
    return np.array(error)


def test_edits_follow_id_order_over_all_ranges(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    error = expected(rows, {r.doc_id: r for r in P.edit_likeness(docs).collect()})
    assert abs(error.mean()) < 0.01 and error.std() < 0.06


def test_few_documents_follow_each_other_around(spark):
    for rows in ([(5, "one alone here")], [(1, "a b c"), (9, "d e f g h i")], [(-3, ""), (2, "é😀 漢"), (4, " ")]):
        expected(rows, {r.doc_id: r for r in P.edit_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()})


def test_odd_rows(odd_docs, no_docs):
    rows = P.edit_likeness(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2, 3)}) == 1 and {r.n_chars for r in rows if r.doc_id == 1} == {0}
    assert len({r.fingerprint for r in rows if r.doc_id in (0, 7)}) == 1
    same = {r.doc_id: r.fingerprint for r in P.fingerprints(odd_docs).where("doc_id in (0, 5, 6)").collect()}
    assert same == {r.doc_id: r.fingerprint for r in rows if r.doc_id in (0, 5, 6)}
    assert P.edit_likeness(no_docs).count() == 0 and P.fingerprints(no_docs).count() == 0


def test_near_copies_match_brute_force(spark, odd_docs, no_docs):
    texts = near_texts(5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r[0]: (r[1], r[2]) for r in P.near_copies(docs).collect()} == brute(texts, CFG.sets)
    by = {r.doc_id: r for r in P.near_copies(odd_docs).collect() if r.doc_id not in (4, None)}
    assert by[7].component_id == 0 and by[1].component_id == 1 and by[1].n_shingles == 0
    assert P.near_copies(no_docs).count() == 0


def test_query_returns_near_copies_of_the_whole_table(spark, odd_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = P.op10_minhash_fingerprints(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute({r.doc_id: r.text for r in docs.collect()}, CFG.sets)
    assert {tuple(r[:7]) for r in rows} == {tuple(r) for r in P.edit_likeness(docs).collect()}
    odd = P.likeness_and_copies(odd_docs).collect()
    assert len(odd) == odd_docs.count() and P.likeness_and_copies(no_docs).count() == 0
    # rows of one id keep their own groups; a null id names only a group of null ids
    assert sorted((r.n_chars, r.n_shingles, r.component_id) for r in odd if r.doc_id == 4) == [(1, 1, 4), (1, 1, 4), (30, 2, 4)]
    assert {r.doc_id: r.component_id for r in odd if r.doc_id in (0, 7)} == {0: 0, 7: 0}
    assert all(r.component_id is None for r in odd if r.doc_id is None)


def test_large_ids_beside_a_null_follow_exactly(spark):
    rows = [(None, "none at all")] + [((1 << 53) + 1 + i, f"text {i} with words {i * i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected(rows, {r.doc_id: r for r in P.edit_likeness(docs).collect()})
