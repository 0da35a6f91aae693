"""Stored tables: schema log, periods, exact side outputs, settled files, whole jobs."""

import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from voltline.catalog import TableModel, table_model
from voltline.operators.load import load_batch, read_rejects
from voltline.operators.sinks import read_written, write_once
from voltline.operators.store import PERIOD, in_periods_of, logged_schema, log_schema, read_table, schema_history, table_schema
from voltline.plans.sql import run_sql


def _units(spark, rows):
    return spark.createDataFrame(rows, "DUID string, START_DATE string, v long").withColumn("START_DATE", F.col("START_DATE").cast("timestamp_ntz"))


def test_a_table_with_a_key_time_is_split_and_a_batch_reads_its_months_only(spark):
    from test_members import rows_read

    d = tempfile.mkdtemp(prefix="run-") + "/DUDETAILSUMMARY"
    model = table_model("DUDETAILSUMMARY")
    rows = [(f"U{i % 7}", f"20{20 + i // 120}-{1 + i % 12:02d}-{1 + i % 28:02d} 00:00:00", i) for i in range(600)]
    first = load_batch(spark, _units(spark, rows), d, model)
    stored = read_table(spark, d)
    assert first.rows_loaded == stored.count() == len({(a, b) for a, b, _ in rows})
    assert stored.schema[PERIOD].dataType.simpleString() == "int"
    assert sorted(x for x in os.listdir(d) if x.startswith("_period"))[:2] == ["_period=202001", "_period=202002"]
    batch = _units(spark, [("U1", "2022-03-01 00:00:00", 1), ("U9", "2022-03-02 00:00:00", 2)])
    bounded = in_periods_of(stored, batch, "START_DATE")
    assert {r[0] for r in bounded.select(PERIOD).distinct().collect()} == {202203}
    assert rows_read(bounded) == sum(b.startswith("2022-03") for a, b in {(a, b) for a, b, _ in rows})
    again = load_batch(spark, _units(spark, rows + [("U9", "2022-03-02 00:00:00", 2), ("U9", "1999-01-01 00:00:00", 3)]), d, model)
    assert (again.rows_loaded, again.already_present) == (2, first.rows_loaded)
    assert run_sql(spark, "SELECT count(*) FROM dudetailsummary WHERE _period = 199901", warehouse=os.path.dirname(d)).first()[0] == 1


def test_periods_beyond_the_list_are_a_range(spark, monkeypatch):
    import voltline.operators.store as store

    monkeypatch.setattr(store, "LISTED_PERIODS", 2)
    target = spark.createDataFrame([(m, 1) for m in (202001, 202002, 202003, 202004, 202012)], f"{PERIOD} int, v int")
    batch = _units(spark, [("a", f"2020-0{m}-01 00:00:00", 1) for m in (2, 3, 4)])
    assert sorted(r[0] for r in in_periods_of(target, batch, "START_DATE").select(PERIOD).collect()) == [202002, 202003, 202004]
    assert in_periods_of(target, batch.limit(0), "START_DATE").count() == 0


def test_an_empty_split_table_has_its_schema(spark):
    d = tempfile.mkdtemp(prefix="run-") + "/DUDETAILSUMMARY"
    report = load_batch(spark, _units(spark, [(None, "2020-01-01 00:00:00", 1)]), d, table_model("DUDETAILSUMMARY"))
    assert report.created and report.rejected == 1 and read_table(spark, d).count() == 0
    assert table_schema(spark, d).fieldNames() == ["DUID", "START_DATE", "v", "_source_file", PERIOD]
    load_batch(spark, _units(spark, [("x", "2020-01-01 00:00:00", 1)]), d, table_model("DUDETAILSUMMARY"))
    assert [r.v for r in read_table(spark, d).collect()] == [1]


def test_the_schema_log_is_what_readers_see(spark):
    d = tempfile.mkdtemp(prefix="run-") + "/T"
    model = TableModel("T", ("k",))
    load_batch(spark, spark.createDataFrame([(1, "a")], "k long, v string"), d, model)
    load_batch(spark, spark.createDataFrame([(2, "b", 2.5)], "k long, v string, w double"), d, model, extra="add")
    assert [tuple(r) for r in read_table(spark, d).select("k", "v", "w").orderBy("k").collect()] == [(1, "a", None), (2, "b", 2.5)]
    assert logged_schema(spark, d).fieldNames() == ["k", "v", "_source_file", "w"]
    assert schema_history(spark, d).groupBy("version").count().orderBy("version").collect()[1][1] == 4
    log_schema(spark, d, logged_schema(spark, d))
    assert schema_history(spark, d).agg(F.max("version")).first()[0] == 3
    other = tempfile.mkdtemp(prefix="run-") + "/plain"
    spark.range(2).write.parquet(other)
    assert logged_schema(spark, other) is None and read_table(spark, other).count() == 2 and table_schema(spark, other + "x") is None


def test_side_outputs_are_replaced_not_repeated(spark):
    d = tempfile.mkdtemp(prefix="run-")
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    for part, batch in (("a", "1"), ("a", "1"), ("b", "1"), ("a", "2"), ("a", "1")):
        assert write_once(rows, f"{d}/out", part, batch) == 2
    assert read_written(spark, f"{d}/out", "k long").count() == 6
    model = TableModel("T", ("k",))
    batch = spark.createDataFrame([("1", "x"), (None, "y"), ("bad", "z")], "k string, v string")
    load_batch(spark, spark.createDataFrame([(7, "s")], "k long, v string"), f"{d}/wh/T", model)
    for _ in range(3):
        load_batch(spark, batch, f"{d}/wh/T", model)
    assert sorted(r.reason for r in read_rejects(spark, f"{d}/wh").collect()) == ["null key: k", "unconvertible: k"]
    load_batch(spark, batch.limit(2), f"{d}/wh/T", model)  # another batch keeps its own
    assert read_rejects(spark, f"{d}/wh").count() == 3


def _report(path, day, rows, table="OTHER"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("I,A,B,1,k,v\n" + "".join(f"D,A,B,1,{k},{v}\n" for k, v in rows))


def _replay(checkpoint, batch):
    """Let the next start run ``batch`` again, as after a crash before its commit."""
    for name in (str(batch), f".{batch}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.unlink(f"{checkpoint}/commits/{name}")


def test_a_replayed_micro_batch_leaves_every_output_as_it_was(spark):
    from voltline.operators.ledger import read_ledger
    from voltline.plans.load import LoadOptions
    from voltline.streaming.loader import start_stream_load

    d = tempfile.mkdtemp(prefix="run-")
    _report(f"{d}/in/a_202601010000.csv", 1, [(1, "x"), (2, "y")])
    with open(f"{d}/in/b_202601010000.csv", "w") as f:
        f.write("D,A,B,1,9,early\nI,A,B,1,k,v\nD,A,B,1,3,z\n")
    run = lambda: start_stream_load(spark, f"{d}/in", f"{d}/wh", f"{d}/ledger", f"{d}/ckpt", LoadOptions(1900, 2100)).awaitTermination()
    run()
    seen = lambda: (sorted(map(str, read_table(spark, f"{d}/wh/OTHER_DATA").collect())), sorted(map(str, read_rejects(spark, f"{d}/wh").collect())),
                    sorted(r.source_file for r in read_ledger(spark, f"{d}/ledger").collect()))
    before = seen()
    assert [len(x) for x in before] == [3, 1, 2]
    for _ in range(2):
        _replay(f"{d}/ckpt", 0)
        run()
        assert seen() == before


def test_a_replayed_plan_leaves_its_manifest_as_it_was(spark):
    from voltline.streaming.planner import MANIFEST_SCHEMA, start_manifest_stream

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/pages")
    for name in ("p1.html", "lost.html"):
        with open(f"{d}/pages/{name}", "w") as f:
            f.write('<a href="a_202601010000.zip">a</a><a href="b_202601010000.zip">b</a>')
    urls = spark.createDataFrame([("p1.html", "https://h.example/x/")], "file_name string, url string")
    run = lambda: start_manifest_stream(spark, f"{d}/pages", urls, f"{d}/m", f"{d}/ckpt", root_url="https://h.example/x/").awaitTermination()
    for _ in range(3):
        run()
        assert read_written(spark, f"{d}/m", MANIFEST_SCHEMA).count() == 2 and read_written(spark, f"{d}/m_unmapped", "file_name string").count() == 1
        _replay(f"{d}/ckpt", 0)


def test_only_files_of_committed_batches_move(spark):
    from voltline.plans.load import LoadOptions
    from voltline.streaming.loader import start_stream_load
    from voltline.streaming.settle import noted_files, settle_files

    d = tempfile.mkdtemp(prefix="run-")
    here = lambda p: sorted(os.path.relpath(os.path.join(a, f), f"{d}/{p}") for a, _, fs in os.walk(f"{d}/{p}") for f in fs if f.endswith("zip"))
    opts = LoadOptions(2026, 2026, (1,))
    for i in range(3):
        os.makedirs(f"{d}/in/sub", exist_ok=True)
        with zipfile.ZipFile(f"{d}/in/sub/drop%23{i}.zip", "w") as z:
            z.writestr(f"OTHER_2026010{i + 1}0000.CSV", f"I,A,B,1,k,v\nD,A,B,1,{i},x\n")
        query = start_stream_load(spark, f"{d}/in", f"{d}/wh", f"{d}/ledger", f"{d}/ckpt", opts, archives=True, archive_dir=f"{d}/done")
        query.awaitTermination()
        assert here("in") == [f"sub/drop%23{i}.zip"] and here("done") == [f"{j}/sub/drop%23{j}.zip" for j in range(i)]
    with zipfile.ZipFile(f"{d}/in/late.zip", "w") as z:
        z.writestr("OTHER_202512010000.CSV", "I,A,B,1,k,v\nD,A,B,1,9,x\n")  # outside the window: never a candidate
    query = start_stream_load(spark, f"{d}/in", f"{d}/wh", f"{d}/ledger", f"{d}/ckpt", opts, archives=True, archive_dir=f"{d}/done")
    query.awaitTermination()
    for moved in (0, 0):  # the start of the last batch moved the others already
        assert settle_files(spark, f"{d}/wh", f"{d}/in", f"{d}/done", query.id) == moved
    assert here("in") == ["late.zip"] and noted_files(spark, f"{d}/wh").count() == 3
    assert sorted(r.k for r in read_table(spark, f"{d}/wh/OTHER_DATA").collect()) == [0, 1, 2]


def test_one_call_plans_expands_and_loads(spark):
    from voltline.plans.job import run_job
    from voltline.plans.load import LoadOptions

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/zips")
    for month in (1, 2, 7):
        with zipfile.ZipFile(f"{d}/zips/PUBLIC_DVD_X_2026{month:02d}010000.zip", "w") as z:
            z.writestr(f"PUBLIC_DVD_TRADINGPRICE_2026{month:02d}010000.CSV",
                       f'I,T,P,2,SETTLEMENTDATE,RUNNO,REGIONID,PERIODID,RRP\nD,T,P,2,"2026/{month:02d}/01 00:05:00",1,R1,1,{month}.5\n')
    with open(f"{d}/zips/broken_202601010000.zip", "w") as f:
        f.write("no zip")
    pages = spark.createDataFrame([(1, "https://h.example/x/", '<a href="PUBLIC_DVD_X_202601010000.zip">1</a><a href="PUBLIC_DVD_X_202603010000.zip">3</a>')], "page_id long, url string, html string")
    opts = LoadOptions(2026, 2026, (1, 2, 3))
    job = run_job(spark, "current", pages, f"{d}/zips", f"{d}/wh", f"{d}/ledger", opts, root_url="https://h.example/x/")
    assert [r.local_name for r in job.manifest.collect()] == ["PUBLIC_DVD_X_202603010000.zip"]
    assert [(r.table_name, r.rows_loaded) for r in job.report.collect()] == [("TRADINGPRICE", 2)]
    assert {r.file_name: r.status for r in job.status.collect()} == {f"PUBLIC_DVD_TRADINGPRICE_2026{m:02d}010000.CSV": "ok" for m in (1, 2)}
    assert [r.source_file.split("!/")[0].rsplit("/", 1)[-1] for r in read_rejects(spark, f"{d}/wh").collect()] == ["broken_202601010000.zip"]
    again = run_job(spark, "current", pages, f"{d}/zips", f"{d}/wh", f"{d}/ledger", opts, root_url="https://h.example/x/")
    assert again.report.count() == 0 and read_rejects(spark, f"{d}/wh").count() == 1
    assert sorted(r.RRP for r in read_table(spark, f"{d}/wh/TRADINGPRICE").collect()) == [1.5, 2.5]


def test_types_and_time_formats_by_file(spark, make_lines):
    from voltline.operators.infer import coerce_first_format, infer_types_by_file, types_of_first_file
    from voltline.plans.load import LoadOptions, load_lines

    rows = spark.createDataFrame([("a", 1, "1", None, "2026/01/01"), ("a", 2, "2", None, "2026-01-02"), ("b", 1, "x", "1.5", None), ("b", 2, None, "2", "2026-01-03 00:00:01"), ("b", 3, "y", None, "2026/1/3")],
                                 "_source_file string, n int, p string, q string, D_DATE string")
    by_file = infer_types_by_file(rows, ["p", "q", "D_DATE"])
    assert {(r.source_file, r.column_name): (r["values"], r.inferred_type) for r in by_file.collect()} == {
        ("a", "p"): (2, "bigint"), ("a", "q"): (0, "double"), ("a", "D_DATE"): (2, "timestamp_ntz"), ("b", "p"): (2, "string"), ("b", "q"): (2, "double"), ("b", "D_DATE"): (2, "timestamp_ntz")}
    assert {k: v.simpleString() for k, v in types_of_first_file(by_file).items()} == {"p": "bigint", "q": "double", "D_DATE": "timestamp_ntz"}
    one = coerce_first_format(rows, ["D_DATE"], ["n"])
    assert sorted((r["_source_file"], r.n, None if r.D_DATE is None else r.D_DATE.day) for r in one.collect()) == [("a", 1, 1), ("a", 2, None), ("b", 1, None), ("b", 2, 3), ("b", 3, None)]
    # the switches of a load: types of the first file that fills a column, one format per file and column
    files = {"a.csv": 'I,X,Y,1,V,E_TIME\nD,X,Y,1,1,"2026/01/01 00:00:01"\nD,X,Y,1,2,"2026-01-01 00:00:02"\n', "b.csv": 'I,X,Y,1,V,E_TIME\nD,X,Y,1,2.5,"2026-01-01 00:00:03"\n'}
    for opts, types, times in ((LoadOptions(), "double", [1, 2, 3]), (LoadOptions(inference="first_file", time_formats="first"), "bigint", [1])):
        d = tempfile.mkdtemp(prefix="run-")
        lines = make_lines(files)
        routes = lines.selectExpr("source_file", "'other_data' AS table_name", "2026 AS year", "1 AS month").distinct()
        load_lines(spark, lines, routes, f"{d}/wh", None, opts)
        stored = read_table(spark, f"{d}/wh/OTHER_DATA")
        assert stored.schema["V"].dataType.simpleString() == types
        assert sorted(r.E_TIME.second for r in stored.collect() if r.E_TIME) == times


def test_numeric_references_and_first_table_of_a_name(spark):
    from voltline.plans.acquire import match_table
    from voltline.sources.links import extract_links

    html = "".join(f'<a href="{h}">x</a>' for h in ("a&#38;amp;b.zip", "&#x41;&#66;&amp;#67;.zip", "&#0;&#xD800;&#x1F600;.zip", "a&nbsp;&b.zip", "plain.zip"))
    pages = spark.createDataFrame([(1, "https://h.example/", html)], "page_id long, url string, html string")
    assert [r.href for r in extract_links(pages).orderBy("position").collect()] == ["a&amp;b.zip", "AB&#67;.zip", "��😀.zip", "a&nbsp;&b.zip", "plain.zip"]
    names = ["PUBLIC_DVD_B_1", "XPUBLIC_ARCHIVE#A#PUBLIC_DVD_B_1", "PUBLIC_DVD_B_PUBLIC_DVD_A_", "PUBLIC_ARCHIVE%23A_B%23", "PUBLIC_DVD_A_B_", "PUBLIC_DVD_C_", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    plain = lambda n, ts: next((t for t in ts if any(x in n for x in (f"PUBLIC_DVD_{t}_", f"PUBLIC_ARCHIVE#{t}#", f"PUBLIC_ARCHIVE%23{t}%23"))), None)
    for tables in (["A", "B", "A_B"], ["A_B", "B", "A"], ["B"], []):
        assert [r[0] for r in df.select(match_table(F.col("n"), tables)).collect()] == [plain(n, tables) for n in names], tables


@pytest.fixture(autouse=True)
def _on_path(monkeypatch):
    monkeypatch.syspath_prepend(os.path.dirname(__file__))
