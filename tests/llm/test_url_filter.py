import duckdb

from voltline.llm import url_filter as U

CASES = [
    ("http://a.com/x", "com/", "allow"), ("http://example.com/en/1", "example.com/en/", "block"), ("https://WWW.Example.com/en/1?q#f", "www.example.com/en/", "allow"),
    ("http://x.net/es/", "net/es/", "block"), ("http://net/fr/1", "net/fr/", "block"), ("http://x.net/ES/", None, "allow"), ("http://a.com", None, "allow"),
    ("http://mycom/", None, "allow"), ("http://casino.org/", None, "block"), ("http://casinos.org/", None, "allow"), ("http://ads-track.example.net/en/", None, "block"),
    ("http://ads.org/ads", None, "allow"), ("http://free.org/WIN", None, "block"), (None, None, "allow"), ("", None, "allow"), ("no scheme casino", None, "block"),
    ("a://b://c.com/en", None, "allow"), ("http://é.org/Free\nwin", None, "block"), ("://x.com/", "com/", "allow"), ("http://spam.com/", "com/", "allow"),
]


def test_rules_terms_and_sql(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, (u, _, _) in enumerate(CASES)] + [(None, "http://a.com/", "x", "y"), (0, CASES[0][0], "x", "y")], "page_id long, url string, host string, verdict string")
    rows = U.url_verdicts(pages).drop("n_strict").collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(CASES) + 2
    for i, (u, rule, verdict) in enumerate(CASES):
        assert (got[i].rule, got[i].verdict) == (rule, verdict), u
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, (u, _, _) in enumerate(CASES)])
    for r in con.execute(U.oracle()).fetchall():
        assert tuple(got[r[0]]) == r
    assert U.url_verdicts(pages.limit(0)).count() == 0


def test_hits_count_strict_and_distinct_soft():
    assert U.hits("casino/casino?free&free=win") == (2, 2, 2.0) and U.hits("freewin") == (0, 0, 0.0) and U.hits("Éfree-") == (0, 1, 1.0)


def test_a_vocabulary_from_a_table(spark):
    rows = [("Poker", "strict", None), ("poker", "soft", 9.0), ("slot", "soft", 0.5), ("slot", "soft", 0.75), ("dice", "soft", None), ("card", "soft", 2.0), ("", "soft", 1.0), (None, "soft", 1.0), ("x", "other", 1.0)]
    terms = spark.createDataFrame(rows, "term string, kind string, weight double")
    words = U.Vocabulary.read(terms, least_distinct=2, least_weight=1.75)
    assert words == U.Vocabulary(("poker",), (("card", 2.0), ("dice", 1.0), ("slot", 0.75)), 2, 1.75)
    pages = spark.createDataFrame([(1, "http://a.org/POKER"), (2, "http://a.org/card"), (3, "http://slot.org/dice/slot"), (4, "http://slot.org/cards"), (5, "http://a.org/card-slot")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.n_soft, r.soft_weight) for r in U.url_verdicts(pages, words=words, rules=[]).collect()}
    assert got == {1: ("block", 0, 0.0), 2: ("allow", 1, 2.0), 3: ("block", 2, 1.75), 4: ("allow", 1, 0.75), 5: ("block", 2, 2.75)}
    empty = U.Vocabulary.read(terms.limit(0))
    assert {r.verdict for r in U.url_verdicts(pages, words=empty, rules=[]).collect()} == {"allow"}
