import random
import zlib

import numpy as np

from voltline.llm import packing as K
from voltline.llm.wordbpe import encoder


def reference(t):
    return np.array(encoder().tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_word_encoder_equals_the_tokenizer():
    assert encoder().merge is not None
    rng = random.Random(2)
    signs = "abcABC'sdtlmrvé ÀÉß.,!09 \n\t<|>́ ǅﬁ漢字²ªİ\x1c\x85　\x00"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["x<|endoftext|>y <|startoftext|>", "", " ", "It's WE'LL don't", "a" * 3000]
    for t, ids in zip(texts, encoder().encode(texts)):
        assert ids == reference(t), repr(t)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(0)
    for window in (1, 7, 64, 2048):
        lengths = sorted((rng.randint(1, window) for _ in range(400)), reverse=True)
        left = []
        want = []
        for n in lengths:  # brute force: the least capacity that holds the piece
            fits = [c for c in left if c >= n]
            want.append(min(fits) if fits else window)
            if fits:
                left[left.index(min(fits))] -= n
            else:
                left.append(window - n)
        placed = K.best_fit_decreasing(lengths, window)
        assert [window - o for _, o in placed] == want


def check_packed(rows, texts, cfg):
    """rows: (doc, start, length, crc, doc_tokens, sequence, offset[, ids]); texts by doc."""
    end = cfg.end_id.to_bytes(4, "little")
    for d, t in texts.items():
        ids = reference(t or "") + end
        own = sorted(r for r in rows if r[0] == d)
        at = 0
        for r in own:
            assert r[1] == at and r[3] == zlib.crc32(ids[4 * at : 4 * (at + r[2])]) and r[4] == len(ids) // 4
            at += r[2]
        assert 4 * at == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r[5], []).append((r[6], r[2]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= cfg.window
    return by


def test_every_id_lies_in_one_piece(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = [tuple(r) for r in K.op9_packing(spark, "/root/testdata/sf0.001").collect()]
    by = check_packed(rows, texts, K.PackConfig())
    total = sum(r[2] for r in rows)
    assert total > 0.98 * 2048 * (len(by) - 1)


def test_groups_and_kept_ids(spark):
    texts = {i: " ".join(f"w{j}" for j in range(i * 7 % 50)) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    cfg = K.PackConfig(window=64, group_pieces=100)
    got = K.pack(docs, cfg=cfg, keep_ids=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids").collect()
    check_packed([tuple(r)[:7] for r in got], texts, cfg)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)


def test_odd_rows(odd_docs, no_docs):
    rows = [tuple(r) for r in K.pack(odd_docs).collect()]
    texts = {r.doc_id: r.text for r in odd_docs.where("doc_id in (0, 1, 2, 3, 5, 6, 7)").collect()}
    check_packed(rows, texts, K.PackConfig())
    assert sum(r[0] == 4 for r in rows) == 3 and sum(r[0] is None for r in rows) == 2
    assert K.pack(no_docs).count() == 0
