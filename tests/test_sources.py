"""S2-S4 archives, S6 links and URL join, Q1 read-only SQL, the driver contract."""

import io
import os
import tempfile
import zipfile
from urllib.parse import urljoin

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from voltline.sources.archives import expand_archives, member_lines, read_archives
from voltline.sources.links import extract_links, resolve_url


def test_nested_archives_and_bad_zip(spark):
    d = tempfile.mkdtemp(prefix="run-")
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("PUBLIC_DVD_X_202601010000.CSV", "I,A,B,1,x\r\nD,A,B,1,1\r\n")
    with zipfile.ZipFile(f"{d}/outer.zip", "w") as z:
        z.writestr("inner.zip", inner.getvalue())
        z.writestr("readme.txt", "hello")
    with open(f"{d}/broken.ZIP", "wb") as f:
        f.write(b"not a zip")
    members = expand_archives(read_archives(spark, d)).collect()
    got = {(r["member"].split("/")[-1], r["depth"], r["error"] is None) for r in members}
    assert ("PUBLIC_DVD_X_202601010000.CSV", 2, True) in got
    assert ("readme.txt", 1, True) in got
    assert any(not ok for _, _, ok in got)  # the broken archive is a row, not a failure or a loop
    lines = member_lines(expand_archives(read_archives(spark, d))).orderBy("line_id").collect()
    assert [r["value"] for r in lines] == ["I,A,B,1,x", "D,A,B,1,1"]


HREFS = ["../up.zip", "a/../b.zip", "../../../x.zip", "/a/./b/../c.zip", "./", "..", "a/..?q=../x", "/a/b.zip", "c.zip", "//h.example/x.zip", "http://o.example/y.zip", "?q=1", "#f", "", "./d.zip", "sub/e.ZIP"]
BASES = ["https://h.example/dir/page.html?x=1#top", "http://h.example", "https://h.example/dir/"]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url_matches_urljoin(spark, base):
    df = spark.createDataFrame([(base, h) for h in HREFS], "b string, h string")
    got = [r[0] for r in df.select(resolve_url("b", "h")).collect()]
    assert got == [urljoin(base, h) for h in HREFS]


def test_links_skip_comments_and_scripts(spark):
    html = ('<a href="A.zip">a</a><!-- <a href="B.zip"> --><script>x="<a href=\'C.zip\'>"</script>'
            '<A HREF="sub/PUBLIC_ARCHIVE%23T%23F.ZIP">d</A><a href="x.html">')
    pages = spark.createDataFrame([(1, "https://h.example/dir/", html)], "page_id long, url string, html string")
    rows = extract_links(pages).collect()
    assert [(r["position"], r["file_name"]) for r in rows] == [(1, "A.ZIP"), (2, "PUBLIC_ARCHIVE#T#F.ZIP")]
    assert rows[1]["url"] == "https://h.example/dir/sub/PUBLIC_ARCHIVE%23T%23F.ZIP"


def test_links_read_attributes_by_name(spark):
    html = ("<a href=plain.zip>a</a><a data-href=\"x.zip\" href='y.zip'>b</a><a class=k\nhref=\"it's.zip\">c</a>"
            '<a href="q.zip?a=1&amp;b=2">d</a><a data-href="no.zip">e</a><abbr href="no.zip">f</abbr><a href = "s&#39;t.zip" download>g</a><a\thref="../up.zip">h</a>')
    pages = spark.createDataFrame([(1, "https://h.example/e/p.html", html)], "page_id long, url string, html string")
    rows = extract_links(pages, suffix=None).orderBy("position").collect()
    assert [r["href"] for r in rows] == ["plain.zip", "y.zip", "it's.zip", "q.zip?a=1&b=2", "s't.zip", "../up.zip"]
    assert rows[-1]["url"] == "https://h.example/up.zip" and rows[3]["url"] == "https://h.example/e/q.zip?a=1&b=2"


def test_deep_nests_and_bad_members(spark):
    from voltline.sources.archives import failed_members

    d = tempfile.mkdtemp(prefix="run-")
    data, name = b"I,A,B,1,x\nD,A,B,1,1\n", "F.CSV"
    for _ in range(20):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr(name, data)
        data, name = buf.getvalue(), "in.zip"
    with zipfile.ZipFile(f"{d}/deep.zip", "w") as z:
        z.writestr("in.zip", data)
        z.writestr("torn.zip", b"not a zip")
    members = expand_archives(read_archives(spark, d)).collect()
    assert [(r["depth"], bytes(r["content"])[:9]) for r in members if r["error"] is None] == [(21, b"I,A,B,1,x")]
    bad = failed_members(expand_archives(read_archives(spark, d))).collect()
    assert [r["file_name"] for r in bad] == ["torn.zip"] and bad[0]["reason"].startswith("bad archive")


def test_run_sql_is_read_only(spark):
    from voltline.plans.sql import run_sql

    df = spark.range(3)
    assert run_sql(spark, "SELECT count(*) AS n FROM {t}", t=df).first()["n"] == 3
    with pytest.raises(PermissionError):
        run_sql(spark, "INSERT INTO x VALUES (1)")
    assert run_sql(spark, "SELECT ';' AS s").first()["s"] == ";"
    assert run_sql(spark, "WITH t AS (SELECT 1 AS a) SELECT a FROM t").first()["a"] == 1
    out = tempfile.mkdtemp(prefix="run-") + "/out"
    for write in (f"WITH t AS (SELECT 1 AS a) INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT * FROM t",
                  f"FROM (SELECT 1 AS a) t INSERT OVERWRITE DIRECTORY '{out}' USING parquet SELECT *",
                  "CREATE TABLE x AS SELECT 1", "DROP TABLE x", "SET a=b", "SHOW TABLES", "CALL p()", "EXECUTE IMMEDIATE 'SELECT 1'"):
        with pytest.raises(PermissionError):
            run_sql(spark, write)
    assert not os.path.exists(out)
    with pytest.raises(ParseException):
        run_sql(spark, "SELECT 1; DROP TABLE x")


def test_entry_contract(spark):
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    df = entry.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns
