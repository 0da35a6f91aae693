import random
import re

import numpy as np
import pyarrow as pa

from voltline.llm.common import rewrite_texts, text_blocks
from voltline.llm.sampling import bounded_sample
from voltline.llm.textarrays import shingles, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_and_hashes_follow_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é漢\t\n\x0b\x1c\u00a0") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    w = words_of(texts)
    got = [w.buf[s:e].tobytes().decode() for s, e in zip(w.start, w.end)]
    want = [WORD.findall(t) for t in texts]
    assert got == [x for ws in want for x in ws]
    assert w.doc.tolist() == [i for i, ws in enumerate(want) for _ in ws]
    by_word = {}
    for x, h in zip(got, w.hash.tolist()):
        assert by_word.setdefault(x, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_of_short_and_empty_texts():
    texts = ["", "a b", "a b c d", "b a"]
    doc, h = shingles(words_of(texts), 3)
    assert doc.tolist() == [1, 2, 2, 3] and len(set(h.tolist())) == 4


def test_lower_maps_ascii_capitals_only():
    a, b = words_of(["ABC É"], lower=True), words_of(["abc É"])
    assert np.array_equal(a.hash, b.hash) and a.hash[1] != words_of(["é"]).hash[0]


def test_blocks_cover_all_texts():
    texts = ["x" * 5, None, "é" * 15, "", "x", "x", "x"]
    parts = list(text_blocks(pa.array(texts, pa.string()), 10))
    assert [t for _, p in parts for t in p] == texts and [i for s, _ in parts for i in range(s.start, s.stop)] == list(range(7))
    assert [len(p) for _, p in parts] == [2, 1, 4] and list(text_blocks(pa.array([], pa.string()))) == []
    sliced = pa.array(["long ago", *texts, "x" * 99], pa.string()).slice(1, 7)
    assert [t for _, p in text_blocks(sliced, 10) for t in p] == texts


def test_rewritten_texts_keep_rows_and_columns(odd_docs):
    got = rewrite_texts(odd_docs, "text", lambda t: t + "!")
    assert got.schema == odd_docs.schema
    want = [r.asDict() | {"text": None if r.text is None else r.text + "!"} for r in odd_docs.collect()]
    key = lambda r: str(sorted((k, str(v)) for k, v in r.items()))
    assert sorted((r.asDict() for r in got.collect()), key=key) == sorted(want, key=key)


def test_bounded_sample_is_bounded_and_repeatable(spark):
    df = spark.range(1000)
    a, b = ({r.id for r in bounded_sample(df.repartition(n), "id", 50).collect()} for n in (2, 7))
    assert a == b and len(a) == 50 and bounded_sample(df, "id", 5000).count() == 1000 and bounded_sample(df.limit(0), "id", 5).count() == 0
