import numpy as np

from voltline.llm import language_id as L


def test_subwords_stay_in_their_text_and_word():
    doc, gram = L.subwords(["ab", "", "a1b", "AB"], 1 << 15)
    by = {d: sorted(gram[doc == d].tolist()) for d in range(4)}
    assert by[0] == by[3] and by[1] == [] and len(by[0]) == 6 and len(by[2]) == 6


def test_held_out_accuracy_and_unknown(spark, odd_docs, no_docs):
    rows = L.op5_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(truth, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97 and rows.count() == 1000
    model = L.train(odd_docs)
    got = L.predict(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (1, 2, 3) or (r.doc_id is None and r.score == 0)) and 0 <= r.score <= 1 for r in got)
    assert L.predict(no_docs, L.train(no_docs)).count() == 0


def test_rejection_is_calibrated():
    texts = [("xx", "abab baba abba " * 3), ("yy", "cdcd dcdc cddc " * 3)] * 40
    counted = L._counts([t for _, t in texts], 1 << 12)
    cfg = L.TrainConfig(buckets=1 << 12)
    m = L.fit([(k, b.astype(int), c.astype(float)) for (k, _), b, c in zip(texts, counted["bucket"], counted["count"])], cfg)
    p, _ = m.probabilities(["abab abba", "cdcd", "zz qq zz"])
    assert m.langs == ["xx", "yy"] and p[0].argmax() == 0 and p[1].argmax() == 1 and p[0].max() >= m.accept > p[2].max()


def test_a_rare_language_is_learned(spark):
    rows = [(i, "the house and the garden are near the old river", "en") for i in range(3000)]
    rows += [(5000 + i, "zażółć gęślą jaźń i źdźbło trawy", "pl") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cfg = L.TrainConfig(sample_rows=60)
    model = L.train(docs, cfg=cfg)
    assert model.langs == ["en", "pl"]
    got = {r.doc_id: r.lang_pred for r in L.predict(docs.where("doc_id % 1000 < 3"), model).collect()}
    assert all(v == ("pl" if d >= 5000 else "en") for d, v in got.items()) and len(got) == 12


def plain_score(m, text):
    """Probabilities by one n-gram after another."""
    t = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    data = t.encode()
    data = b" " + b" ".join(data.split()) + b" " if data.split() else b"  "
    total, n = np.zeros(len(m.langs)), 0
    for k in L.ORDERS:
        for i in range(len(data) - k + 1):
            if b" " in data[i + 1 : i + k - 1]:
                continue
            h = data[i] * 0x01000193 % 2**32
            for c in data[i + 1 : i + k]:
                h = (h ^ c) * 0x01000193 % 2**32
            h = (h ^ h >> 15) * 0x85EBCA6B % 2**32
            total += m.table[(h >> 16 ^ h) & (len(m.table) - 1)]
            n += 1
    z = (total / max(n, 1) + m.bias) / m.temperature
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def test_scores_against_single_ngrams():
    rng = np.random.default_rng(2)
    m = L.LanguageModel(["aa", "bb", "cc"], rng.normal(0, 3, (1 << 12, 3)).astype(np.float32), rng.normal(0, 1, 3), 0.7)
    texts = ["Ein Haus, und 3 Mäuse", "x", "l'été  à\nla mer", "漢字 kana", "a-b-c", "word " * 200]
    p, _ = m.probabilities(texts)
    for row, t in zip(p, texts):
        assert np.allclose(row, plain_score(m, t), atol=1e-5), t


def test_ties_take_the_first_language(spark):
    m = L.LanguageModel(["aa", "bb"], np.zeros((1 << 12, 2), np.float32), np.zeros(2))
    docs = spark.createDataFrame([(1, "some words"), (2, "")], "doc_id long, text string")
    assert {(r.doc_id, r.lang_pred, r.score) for r in L.predict(docs, m).collect()} == {(1, "aa", 0.5), (2, "und", 0.0)}
