import itertools
import random

import numpy as np

from voltline.llm import line_quality as L


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    sizes = [3, 0, 1, 5, 2]
    off = np.concatenate([[0], np.cumsum(sizes)])
    odds, move = rng.normal(0, 2, off[-1]), rng.normal(0, 1, (2, 2))
    good, pairs, log_z = L.marginals(odds, move, off)
    want_pairs = np.zeros((2, 2))
    for i, n in enumerate(sizes):
        z, p, t = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(odds[off[i] + j] * y[j] for j in range(n)) + sum(move[a, b] for a, b in zip(y, y[1:])))
            z += w
            p += w * np.array(y) if n else 0
            for a, b in zip(y, y[1:]):
                t[a, b] += w
        assert np.allclose(good[off[i] : off[i + 1]], p / z) and (n == 0 or np.isclose(log_z[i], np.log(z)))
        want_pairs += t / z
    assert np.allclose(pairs, want_pairs)


def test_neighbours_stay_inside_their_text():
    lines = L.lines_of(["A B\n\nc d", "", "x # y"])
    assert lines.doc.tolist() == [0, 0, 2]
    x = lines.features()
    own = lines.own
    assert np.allclose(x[0, L.N_OWN : 2 * L.N_OWN], 0) and np.allclose(x[0, 2 * L.N_OWN : 3 * L.N_OWN], own[1]) and np.allclose(x[2, L.N_OWN : 3 * L.N_OWN], 0)


def _planted(n, seed):
    rng = random.Random(seed)
    words = ["the", "and", "tion", "ofer", "sten", "line", "when", "there"]
    out = []
    for i in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 15))).capitalize() + "." for _ in range(rng.randint(1, 6))]
        good = rng.random() < 0.7
        if not good:
            kind = rng.randint(0, 2)
            lines = [x.upper() + "!!" if kind == 0 else " ".join(w + "###" for w in x.split()) if kind == 1 else " | ".join(x.split()) for x in lines]
        out.append((i, "\n".join(lines), int(good)))
    return out


def test_learns_planted_quality(spark):
    docs = spark.createDataFrame(_planted(500, 1), "doc_id long, text string, quality int")
    model = L.train(docs, docs.select("doc_id", "quality"))
    held = _planted(200, 2)
    p = model.scores([t for _, t, _ in held])
    assert np.mean((p >= 0.5) == [bool(q) for *_, q in held]) > 0.97
    assert model.scores(["", " \n "]).tolist() == [model.empty] * 2


def test_held_out_accuracy(spark):
    rows = L.op3_quality_classifier(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert rows.count() == 1000 and np.mean([r.predicted == r.quality for r in held]) > 0.93


def test_operator_on_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, None), (5, 0), (None, 1), (99, 0)], "doc_id long, quality int")
    model = L.train(odd_docs, labels)
    rows = L.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert L.score(no_docs, L.train(no_docs, labels.limit(0))).count() == 0
    assert L.keep_good(odd_docs, model).columns == odd_docs.columns


def test_a_document_of_many_lines_is_in_the_fit(spark):
    rows = [(i, "A plain line of some words here.\n" * 5000 if i == 0 else "A plain line of some words here.", 1) for i in range(4)]
    rows += [(10 + i, "BUY $$$ NOW ||| !!!\n" * 3, 0) for i in range(4)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    seen = []
    real = L.fit
    try:
        L.fit = lambda own, size, y, cfg: seen.append(sorted(map(len, own))) or real(own, size, y, cfg)
        model = L.train(docs, labels, cfg=L.CrfConfig(steps=40))
    finally:
        L.fit = real
    assert seen == [[1, 1, 1, 3, 3, 3, 3, 5000]]
    got = {r.doc_id: r.predicted for r in L.score(docs, model).collect()}
    assert all(got[i] == (i < 10) for i in got)
    # the score by hand: length-weighted marginals of the chain, calibrated
    text = "A line. BUY $$$\n\nMore ||| words !!! here"
    lines = L.lines_of([text])
    p = L.marginals(lines.features() @ model.weight, model.move, lines.offsets())[0]
    mean = sum(s * q for s, q in zip(lines.size, p)) / sum(lines.size)
    z = model.scale * np.log(mean / (1 - mean)) + model.shift
    assert np.isclose(model.scores([text])[0], 1 / (1 + np.exp(-z)), atol=1e-6)
