import random

import corpus_pipeline as C
import numpy as np
import pytest

from voltline.llm import line_quality, secret_scans
from voltline.llm.quality_rules import RepetitionLimits, measure
from voltline.llm.wordbpe import encoder

from test_set_join import brute


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(8)
    words = ["the", "and", "tion", "ofer", "sten", "line", "when", "there"] + [f"w{i}" for i in range(3000)]
    say = lambda n: ". ".join(" ".join(rng.choice(words) for _ in range(10)).capitalize() for _ in range(n)) + "."
    rows, labels = [], []
    for i in range(300):
        good = i % 4 != 0
        text = "\n".join(say(3) for _ in range(4))
        rows.append([i, text if good else text.upper().replace(" ", "!! ")])
        labels.append((i, int(good), 0))
    rows += [[400, rows[1][1]], [401, rows[2][1].replace("the", "uvw", 1)], [402, rows[3][1] + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'], [403, None], [404, "short"], [405, "again and again " * 60], [None, rows[5][1] + " " + say(20)]]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_each_stage_against_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality rules", "quality classifier", "n-gram Jaccard join", "secret scans", "packing"]
    stage = dict(C.STAGES)
    one = stage["quality rules"](spark, docs, corpus).cache()
    rows = docs.collect()
    kept = measure([r.text or "" for r in rows], RepetitionLimits())["kept"]
    assert sorted(map(str, one.collect())) == sorted(str(r) for r, k in zip(rows, kept) if k) and one.columns == docs.columns
    two = stage["quality classifier"](spark, one, corpus).cache()
    model = line_quality.trained_on(spark, one, corpus)
    good = model.scores([r.text for r in one.collect()]) >= 0.5
    assert sorted(map(str, two.collect())) == sorted(str(r) for r, k in zip(one.collect(), good) if k)
    ids = {r.doc_id for r in two.collect()}
    assert len(ids & {i for i in range(300) if i % 4}) > 220 and len(ids & {i for i in range(0, 300, 4)}) < 4
    three = stage["n-gram Jaccard join"](spark, two, corpus).cache()
    left = {r.doc_id: r.text for r in two.collect()}
    none = left.pop(None)
    want = {d for d, (_, c) in brute(left, C.NEAR).items() if c == d}
    assert {r.doc_id for r in three.collect()} - {None} == want and not {400, 401} & want and none is not None
    four = stage["secret scans"](spark, three, corpus).cache()
    by = {r.doc_id: r for r in four.collect()}
    for r in three.collect():
        assert by[r.doc_id].text == secret_scans.mask(r.text) and by[r.doc_id].n_chars == len(by[r.doc_id].text)
    five = stage["packing"](spark, four, corpus).collect()
    for d, r in by.items():
        assert sum(p.length for p in five if p.doc_id == d) == len(encoder().encode([r.text])[0]) // 4 + 1


def test_run_applies_all_stages(spark, corpus):
    assert C.ORACLE_SQL is None
    rows = C.run(spark, corpus).collect()
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(rows[0].asDict())
    assert np.all([0 < r.length <= 2048 for r in rows]) and 400 not in {r.doc_id for r in rows}


def test_stages_on_empty_tables(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, corpus)
    assert docs.count() == 0
