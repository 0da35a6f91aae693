import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from voltline.llm.components import components
from voltline.llm.linking import Similarity
from voltline.llm.set_join import keep_one, op8_jaccard_join, similar_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, sim):
    """{doc: (set size, least doc reachable)}, by comparing all pairs that share a shingle."""
    sets, find = {}, {}
    for d, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER) if sim.lower else t or "")
        sets[d] = {tuple(w[i : i + sim.shingle]) for i in range(max(1, len(w) - sim.shingle + 1))} if w else set()
        find[d] = d

    def root(x):
        while find[x] != x:
            x = find[x]
        return x

    index = collections.defaultdict(list)
    for d, s in sets.items():
        near = collections.Counter(e for t in s for e in index[t])
        for e, both in near.items():
            if sim.den * both >= sim.num * (len(s) + len(sets[e]) - both):
                a, b = root(d), root(e)
                find[max(a, b)] = min(a, b)
        for t in s:
            index[t].append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def result(df):
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def test_whole_table_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert result(op8_jaccard_join(spark, "/root/testdata/sf0.001")) == brute(texts, Similarity())


def near_copies(seed):
    """Groups of copies with edits around the threshold, a shared passage, short texts, chains."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([9, 12, 40, 120]))]
        for _ in range(rng.randint(1, 25)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t + passage if rng.random() < 0.2 else t))
    chain = [word() for _ in range(200)]
    for i in range(30):  # each links to the next, far ones don't link
        chain[i * 6] = word()
        texts.append(" ".join(chain))
    texts += [" ".join(word() for _ in range(rng.randint(0, 9))) for _ in range(40)] + ["", " ", "A b", "a B"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("sim", [Similarity(), Similarity(5, 80, 100, False)])
def test_edited_copies_match_brute_force(spark, sim):
    texts = near_copies(sim.shingle)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    want = brute(texts, sim)
    assert result(similar_components(docs, sim=sim)) == want
    kept = {r.doc_id for r in keep_one(docs, sim=sim).collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d}


def test_one_hot_group(spark):
    """A group of similar texts beside thousands of equal ones: no pairs within the group are spelled out."""
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[: i % 80] + [f"x{i % 400}"] + base[i % 80 + 1 :])) for i in range(2000)]
    got = result(similar_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(dict(rows), Similarity())


def test_odd_rows(odd_docs, no_docs):
    rows = similar_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id not in (4, None)}
    assert by[7].component_id == 0 and by[0].component_id == 0 and [by[i].component_id for i in (1, 2, 3)] == [1, 2, 3] and by[1].n_shingles == 0
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id is None} == {(1, None), (0, None)}
    assert similar_components(no_docs).count() == 0 and keep_one(no_docs).count() == 0
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    # of "a" twice under id 4 one stays, 7 goes as a copy of 0; rows without words stay
    assert sorted(str((r.doc_id, r.text and r.text[:7])) for r in kept.collect()) == sorted(
        str((r.doc_id, r.text and r.text[:7])) for r in odd_docs.where(F.coalesce("doc_id", F.lit(-1)) != 7).dropDuplicates(["doc_id", "text"]).collect()
    )


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200), (250, 300), (200, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100), **dict.fromkeys((200, 250, 300), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
