import collections
import random
import re

from voltline.llm.quality_rules import RepetitionLimits, keep_regular, measure, repetition_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIM = RepetitionLimits()


def brute(t):
    ws = WORD.findall(t)
    n = len(ws)
    best = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and ws[i + k] == ws[j + k]:
                k += 1
            best[i] = max(best[i], k)
    windows = collections.Counter(tuple(ws[i : i + 3]) for i in range(n - 2))
    marked = {i + j for i in range(n - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    cover = {j for i in range(n) if best[i] >= LIM.min_repeat for j in range(i, i + best[i])}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = n < 50 or 100 * len(marked) > 50 * n
    longest = max(best, default=0)
    bad = len(cover) > LIM.max_covered * n or (longest > LIM.long_repeat and longest > LIM.max_longest * n)
    return n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), dup, len(marked), failed, not failed and not bad, len(cover), longest, cover


def test_measures_match_brute_force():
    rng = random.Random(0)
    passage = " ".join(f"p{i}" for i in range(45))
    texts = ["", "  ", "a", "é é é é", "a\na\n\n\na", "x y " * 100, passage + " q " + passage, " ".join(f"w{i}" for i in range(200))]
    texts += [" ".join(rng.choice(["a", "bb", "c#", "é\n", f"u{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    got = measure(texts, LIM)
    for i, t in enumerate(texts):
        *want, cover = brute(t)
        assert [got[k][i] for k in list(got)[:9]] == want, t
        spans = [tuple(map(int, s.split(":"))) for s in got["repeat_spans"][i].split(",") if s]
        assert {j for s, e in spans for j in range(s, e)} == cover


def test_long_repeats_reject_and_plain_text_stays():
    passage = " ".join(f"p{i}" for i in range(60))
    plain = " ".join(f"w{i}" for i in range(300))
    got = measure([passage + " x " + plain[:300] + " y " + passage, plain], LIM)
    assert list(got["base_failed"]) == [True, False] or not got["kept"][0]
    assert list(got["kept"]) == [False, True]


def test_operator_on_odd_rows(odd_docs, no_docs):
    rows = repetition_rules(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    long_row = next(r for r in rows if r.doc_id == 5)
    assert long_row.n_words == 30_001 and not long_row.kept and long_row.longest_repeat == 30_000 - 977
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id != 5)
    assert repetition_rules(no_docs).count() == 0
    assert keep_regular(odd_docs).columns == odd_docs.columns and keep_regular(odd_docs).count() == 0
