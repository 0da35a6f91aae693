import hashlib
import itertools
import random
import re

import numpy as np

from voltline.llm import personal_data as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab1230.@+- ()") for _ in range(rng.randint(0, 120))) for _ in range(5000)]
    for t in [*texts, "x@y.z@a.b.c", "@a.b", "1.2.3.4.5.6.7.8", "0000000001.2.3.4", "9" * 4000 + ".1.1.1", "4111 1111 1111 1111", "+49 (30) 123-4567"]:
        assert P.matches(t)[0] == brute(t), t


def test_message_passing_is_exact_on_a_chain():
    rng = np.random.default_rng(5)
    cfg = P.FieldConfig(rounds=60, damping=0.0)
    f = P.Field(rng.normal(0, 1, (P.BUCKETS, P.N_LABELS)), rng.normal(0, 1, (P.N_LABELS, P.N_LABELS)), 0.7, cfg)
    feature = rng.integers(0, P.BUCKETS, (4, P.N_FEATURES))
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[0, 3]])
    phi = f.unary[feature].sum(1)
    total = np.zeros((4, P.N_LABELS))
    for y in itertools.product(range(P.N_LABELS), repeat=4):
        w = np.exp(sum(phi[i, y[i]] for i in range(4)) + f.move[y[0], y[1]] + f.move[y[1], y[2]] + f.agree * (y[0] == y[3]))
        for i in range(4):
            total[i, y[i]] += w
    assert np.allclose(f.marginals(feature, chain, skip), total / total.sum(1, keepdims=True), atol=1e-3)


def _fitted():
    rng = random.Random(2)
    parts, labels = [], []
    for _ in range(400):
        words = [rng.choice(["and", "the", "of", "3.", "4.0", "2020", "x7"]) for _ in range(6)]
        secret = rng.choice(["4111111111111111", f"a{rng.randint(1, 99)}@mail.org", f"10.0.{rng.randint(0, 255)}.7", f"+1 (212) 555-{rng.randint(1000, 9999)}"])
        for _ in range(rng.randint(1, 2)):  # some repeat in their text
            words.insert(rng.randint(0, 6), secret)
        t = " ".join(words)
        parts.append(P.nodes_of(t))
        labels.append(P.node_labels(parts[-1], *P.matches(t)))
    feature, chain, skip, _ = P._together(parts)
    return P.fit(feature, np.concatenate(labels), chain, skip)


def test_field_adds_numbers_that_fail_their_check_and_leaves_plain_ones():
    f = _fitted()
    (base, added), (_, none) = P.find(["card 4111111111111112 here, 4111111111111112 again", "chapter 3. of 4.0 in 2020"], f)
    assert base == [] and added == [("card", 5, 21), ("card", 28, 44)] and none == []


def test_skip_links_carry_a_label_to_a_repeat():
    f = _fitted()
    text = "x x x x a12@mail.org x x x x x x x x A12@ x"
    nodes = P.nodes_of(text)
    assert nodes.skip.tolist() == [[0, 1]]
    alone = f.marginals(nodes.feature, nodes.chain, nodes.skip[:0])[1, 1]
    assert f.marginals(nodes.feature, nodes.chain, nodes.skip)[1, 1] > alone


def test_operator_on_odd_rows(spark, odd_docs, no_docs):
    f = P.train(odd_docs)
    rows = P.personal_spans(odd_docs, f).collect()
    assert len(rows) == odd_docs.count() and all(r.n_email == 0 for r in rows)
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert P.personal_spans(no_docs, P.train(no_docs)).count() == 0


def test_evidence_reaches_all_occurrences_of_a_token():
    f = P.Field(np.zeros((P.BUCKETS, P.N_LABELS)), np.zeros((P.N_LABELS, P.N_LABELS)), 20.0, P.FieldConfig())
    f.unary[P._bucket("cue", "phone"), 1 + P.ORDER["phone"]] = 12.0
    for at in (0, 30, 59):
        text = "\n".join(f"{'phone' if i == at else 'word'} 5550199 end" for i in range(60))
        nodes = P.nodes_of(text)
        p = f.marginals(nodes.feature, nodes.chain, nodes.skip)
        assert len(p) == 60 and (p[:, 1 + P.ORDER["phone"]] > 0.9).all(), at


def test_a_texts_marginals_do_not_depend_on_its_neighbours():
    f = _fitted()
    texts = ["phone 555 0199 end", "x 4111111111111112 y 4111111111111112 z a1@b", "word\n".join(f"5550199 {i}" for i in range(40)), "", "no node"]
    parts = [P.nodes_of(t) for t in texts]
    feature, chain, skip, off = P._together(parts)
    together = f.marginals(feature, chain, skip, off)
    for p, a, b in zip(parts, off, off[1:]):
        assert np.array_equal(together[a:b], f.marginals(p.feature, p.chain, p.skip))


def test_a_long_document_is_in_the_fit(spark):
    long = " ".join(f"Karte 41111111111111{i % 90 + 10} und" for i in range(3000))
    docs = spark.createDataFrame([(1, long), (2, "kein Wort")], "doc_id long, text string")
    f = P.train(docs)
    assert f.unary[P._bucket("cue", "karte"), 1 + P.ORDER["card"]] > f.unary[P._bucket("cue", "und"), 1 + P.ORDER["card"]]
