"""D1, J1, D2, E1-E3, K1-K3, F8 on real files in a scratch folder."""

import tempfile

from pyspark.sql import functions as F

from voltline.catalog import TableModel
from voltline.operators.align import align_schema, cast_to_target
from voltline.operators.dedupe import anti_join_new, dedupe_first, pk_audit
from voltline.operators.ledger import ledger_skip, read_ledger
from voltline.operators.load import read_rejects
from voltline.plans.load import LoadOptions, load_inbox

HEAD = "I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION,RRP\r\n"


def _write(d, name, body, raw=b""):
    with open(f"{d}/{name}", "wb") as f:
        f.write(body.encode() + raw)


def test_load_inbox_dedupe_anti_join_and_replay(spark):
    d = tempfile.mkdtemp(prefix="run-")
    inbox = f"{d}/inbox"
    import os

    os.makedirs(inbox)
    rows1 = ('D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,1,0,10.5\r\n'
             'D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,1,0,11.5\r\n'   # duplicate key in file: first wins
             'D,DISPATCH,PRICE,5,"2026/01/01 00:10:00",1,,2,0,12.5\r\n')    # NULL key component: rejected
    _write(inbox, "PUBLIC_DVD_DISPATCHPRICE_202601010000.CSV", "C,x\r\n" + HEAD + rows1)
    opts = LoadOptions(start_year=2026, end_year=2026, months=(1, 2, 3))
    status, report = load_inbox(spark, inbox, f"{d}/wh", f"{d}/ledger", opts)
    rep = report.collect()[0]
    assert (rep["rows_in"], rep["dup_in_batch"], rep["rejected"], rep["rows_loaded"]) == (3, 1, 1, 1)
    t = spark.read.parquet(f"{d}/wh/DISPATCHPRICE")
    assert [r["RRP"] for r in t.collect()] == [10.5]
    assert [r["rows_loaded"] for r in read_ledger(spark, f"{d}/ledger").collect()] == [1]
    # second file: one key already present, one new, one NULL key again
    rows2 = ('D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,1,0,99.0\r\n'
             'D,DISPATCH,PRICE,5,"2026/01/01 00:15:00",1,R1,3,0,13.5\r\n'
             'D,DISPATCH,PRICE,5,"2026/01/01 00:10:00",1,,2,0,12.5\r\n')
    _write(inbox, "PUBLIC_DVD_DISPATCHPRICE_202601020000.CSV", HEAD + rows2, raw=b"C,bad byte \xff\r\n")
    status, report = load_inbox(spark, inbox, f"{d}/wh", f"{d}/ledger", opts)
    rep = report.collect()[0]
    assert (rep["rows_in"], rep["already_present"], rep["rejected"], rep["rows_loaded"]) == (3, 1, 1, 1)
    assert spark.read.parquet(f"{d}/wh/DISPATCHPRICE").count() == 2
    rejects = read_rejects(spark, f"{d}/wh").collect()
    assert [(r["table_name"], r["reason"]) for r in rejects] == [("DISPATCHPRICE", "null key: REGIONID")] * 2 and '"RRP":12.5' in rejects[0]["row"]
    # third run: ledger (file grain) skips both files
    status, report = load_inbox(spark, inbox, f"{d}/wh", f"{d}/ledger", opts)
    assert report.count() == 0
    assert read_ledger(spark, f"{d}/ledger").count() == 2


def test_out_of_window_and_missing_columns(spark):
    import os

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/inbox")
    _write(f"{d}/inbox", "PUBLIC_DVD_DISPATCHPRICE_202501010000.CSV", HEAD + 'D,DISPATCH,PRICE,5,"2025/01/01 00:05:00",1,R1,1,0,1\n')
    _write(f"{d}/inbox", "other.csv", "I,X,Y,1,a,b\nD,X,Y,1,1,2\n")
    opts = LoadOptions(start_year=2026, end_year=2026, months=(1,))
    _, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger", opts)
    assert [r["table_name"] for r in report.collect()] == ["OTHER_DATA"]  # the 2025 file is outside the window
    # later file for OTHER_DATA lacks column b and has an extra column c
    _write(f"{d}/inbox", "other2.csv", "I,X,Y,1,a,c\nD,X,Y,1,3,4\n")
    load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger", opts)
    t = spark.read.parquet(f"{d}/wh/OTHER_DATA").orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in t] == [(1, 2), (3, None)]
    assert "c" not in t[0].asDict()


def test_dedupe_anti_join_audit(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (None, "c", 3), (None, "d", 4), (2, "e", 5)], "k int, v string, o int")
    first = {(r["k"], r["v"]) for r in dedupe_first(df, ["k"], ["o"]).collect()}
    assert first == {(1, "b"), (None, "c"), (2, "e")}  # NULL keys compare equal inside a batch
    target = spark.createDataFrame([(1,), (None,)], "k int")
    new = {(r["k"], r["v"]) for r in anti_join_new(df, target, ["k"]).collect()}
    assert new == {(None, "c"), (None, "d"), (2, "e")}  # a NULL key never matches the target
    audit = pk_audit(df, ["k"]).first()
    assert (audit["rows"], audit["null_keys"], audit["dup_groups"], audit["surplus_rows"]) == (5, 2, 1, 1)


def test_later_loads_coerce_dates_and_report_what_they_reject(spark):
    import os

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/inbox")
    head = "I,X,Y,1,EVENT_TIME,V,W\n"
    _write(f"{d}/inbox", "a.csv", head + 'D,X,Y,1,"2026/01/01 00:05:00",1.5,x\nD,X,Y,1,junk,2.5,y\n')
    _, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger")
    assert (report.first()["rows_in"], report.first()["rows_loaded"]) == (2, 2)
    _write(f"{d}/inbox", "b.csv", "D,X,Y,1,early,0,z\n" + head + "D,X,Y,1,junk,3.5,x\nD,X,Y,1,junk,abc,y\n")
    _write(f"{d}/inbox", "none.csv", "C,nothing\n")
    status, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger")
    rep = report.first()
    assert (rep["rows_in"], rep["rejected"], rep["rows_loaded"]) == (2, 1, 1)
    assert sorted(((r["EVENT_TIME"] is None), r["V"]) for r in spark.read.parquet(f"{d}/wh/OTHER_DATA").collect()) == [(False, 1.5), (True, 2.5), (True, 3.5)]
    assert sorted(r["reason"] for r in read_rejects(spark, f"{d}/wh").collect()) == ["no header before the line", "unconvertible: V"]
    assert {r["file_name"]: r["status"] for r in status.collect()} == {"b.csv": "ok", "none.csv": "no_header_or_data"}
    assert {r["source_file"].split("/")[-1]: r["rows_loaded"] for r in read_ledger(spark, f"{d}/ledger").collect()} == {"a.csv": 2, "b.csv": 1}


def test_odd_file_names_load_once_by_either_route(spark, monkeypatch):
    import os

    import voltline.plans.load as pl

    names = ["PUBLIC_ARCHIVE%23TRADINGPRICE%23FILE01%23202601010000.CSV", "PUBLIC_ARCHIVE#TRADINGPRICE#FILE01#202601020000.CSV", "a+b c.csv", "report[1].csv", "report1.csv", "x{y}*.csv"]
    seen = []
    for most in (100, 0):
        d = tempfile.mkdtemp(prefix="run-")
        os.makedirs(f"{d}/inbox")
        for i, n in enumerate(names):
            _write(f"{d}/inbox", n, f'I,T,P,2,SETTLEMENTDATE,RUNNO,REGIONID,PERIODID,RRP\nD,T,P,2,"2026/01/01 00:{i:02d}:00",1,R1,{i},{i}.5\n')
        monkeypatch.setattr(pl, "PATH_LIST_MAX", most)
        status, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger")
        assert sorted(r["file_name"] for r in status.collect()) == sorted(names)
        seen.append(sorted((r["table_name"], r["rows_loaded"]) for r in report.collect()))
        ledger = read_ledger(spark, f"{d}/ledger")
        assert sorted(r["source_file"].split("/")[-1] for r in ledger.collect()) == sorted(names)
        _, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger")
        assert report.count() == 0
        # delivered again under its old name with one more row
        _write(f"{d}/inbox", names[0], 'I,T,P,2,SETTLEMENTDATE,RUNNO,REGIONID,PERIODID,RRP\nD,T,P,2,"2026/01/01 00:00:00",1,R1,0,0.5\nD,T,P,2,"2026/01/01 09:00:00",1,R1,9,9.5\n')
        _, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger")
        assert [(r["table_name"], r["already_present"], r["rows_loaded"]) for r in report.collect()] == [("TRADINGPRICE", 1, 1)]
    assert seen[0] == seen[1] == [("OTHER_DATA", 4), ("TRADINGPRICE", 2)]


def test_extra_columns_are_added_or_named(spark):
    from voltline.operators.load import load_batch

    d = tempfile.mkdtemp(prefix="run-")
    model = TableModel("T", ("k",))
    load_batch(spark, spark.createDataFrame([(1, "a")], "k long, v string"), f"{d}/T", model)
    more = spark.createDataFrame([(2, "b", "new")], "k long, v string, `odd``name` string")
    assert load_batch(spark, more, f"{d}/T", model).dropped_columns == ["odd`name"]
    more = spark.createDataFrame([(3, "c", "new")], "k long, v string, `odd``name` string")
    load_batch(spark, more, f"{d}/T", model, extra="add")
    rows = {r["k"]: r.asDict() for r in spark.read.option("mergeSchema", "true").parquet(f"{d}/T").collect()}
    assert rows[3]["odd`name"] == "new" and rows[2]["odd`name"] is None and sorted(rows) == [1, 2, 3]


def test_wide_integers_stay_text_and_bad_headers_fail_their_file_only(spark, make_lines):
    from voltline.operators.infer import infer_types
    from voltline.operators.report import parse_report

    df = spark.createDataFrame([("10000000000000000001", "007", None), ("10000000000000000002", "8", "true")], "w string, i string, b string")
    assert {k: v.simpleString() for k, v in infer_types(df, ["w", "i", "b"]).items()} == {"w": "string", "i": "bigint", "b": "boolean"}
    lines = make_lines({"case.csv": "I,X,Y,1,a,A\nD,X,Y,1,1,2\n", "tick.csv": "I,X,Y,1,a`b,c.d\nD,X,Y,1,1,2\n"})
    parsed = parse_report(lines)
    assert {r["file_name"]: r["status"] for r in parsed.file_status().collect()} == {"case.csv": "bad_header", "tick.csv": "ok"}
    layout = next(x for x in parsed.layouts if x.ok)
    assert parsed.strings(layout).collect()[0]["a`b"] == "1" and infer_types(parsed.strings(layout), ["a`b", "c.d"])["c.d"].simpleString() == "bigint"


def test_checkpoint_root_is_refused_on_a_cluster(spark, monkeypatch):
    import pytest

    from voltline import session

    class Fake:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Fake()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_align_and_cast(spark):
    target = spark.createDataFrame([], "a bigint, b double, c string").schema
    batch = spark.createDataFrame([("1", "x", "2.5"), ("2", "y", "bad")], "a string, extra string, b string")
    al = align_schema(batch, target)
    assert al.added == ["c"] and al.dropped == ["extra"]
    good, bad = cast_to_target(al.frame, target)
    assert [tuple(r) for r in good.collect()] == [(1, 2.5, None)]
    assert bad.first()["_reject_reason"] == "unconvertible: b"


def test_ledger_month_grain(spark):
    cand = spark.createDataFrame(
        [("f1", "t", 2026, 1), ("f2", "t", 2026, 1), ("f3", "t", 2026, 2), ("f4", "t", None, None)],
        "source_file string, table_name string, year int, month int",
    )
    ledger = spark.createDataFrame([("t", 2026, 2, "old", 1, None, None, None)], read_ledger(spark, None).schema)
    kept = sorted(r["source_file"] for r in ledger_skip(cand, ledger, grain="month").collect())
    assert kept == ["f1", "f4"]
    kept = sorted(r["source_file"] for r in ledger_skip(cand, ledger, grain="file").collect())
    assert kept == ["f1", "f2", "f3", "f4"]


def test_declared_schema_replaces_inference(spark, make_lines):
    from pyspark.sql import types as T

    from voltline.plans.load import load_lines

    d = tempfile.mkdtemp(prefix="run-")
    text = ("I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION,RRP,LASTCHANGED\n"
            'D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,1,0,10.5,"2026/01/01 00:00:04"\n')
    lines = make_lines({"PUBLIC_DVD_DISPATCHPRICE_202601010000.CSV": text})
    routes = spark.createDataFrame([("inbox/PUBLIC_DVD_DISPATCHPRICE_202601010000.CSV", "dispatchprice", 2026, 1)],
                                   "source_file string, table_name string, year int, month int")
    declared = T.StructType([
        T.StructField("SETTLEMENTDATE", T.TimestampNTZType()), T.StructField("RUNNO", T.LongType()),
        T.StructField("REGIONID", T.StringType()), T.StructField("DISPATCHINTERVAL", T.LongType()),
        T.StructField("INTERVENTION", T.LongType()), T.StructField("RRP", T.DoubleType()),
        T.StructField("LASTCHANGED", T.TimestampNTZType()),
    ])
    load_lines(spark, lines, routes, f"{d}/wh", None, declared={"DISPATCHPRICE": declared})
    t = spark.read.parquet(f"{d}/wh/DISPATCHPRICE")
    assert t.schema["LASTCHANGED"].dataType == T.TimestampNTZType()
    assert t.first()["LASTCHANGED"].second == 4


def test_bound_target_keeps_anti_join_exact(spark):
    from voltline.operators.load import bound_target

    batch = spark.createDataFrame(
        [("2026-01-01 00:05:00", 1), ("2026-01-01 00:10:00", 2), (None, 3)], "k string, v int"
    ).selectExpr("CAST(k AS TIMESTAMP_NTZ) AS k", "v")
    target = spark.createDataFrame(
        [("2026-01-01 00:05:00",), ("2025-12-31 23:55:00",), ("2026-01-01 00:15:00",), (None,)], "k string"
    ).selectExpr("CAST(k AS TIMESTAMP_NTZ) AS k")
    bounded = bound_target(target, batch, "k")
    assert sorted(str(r["k"]) for r in bounded.collect()) == ["2026-01-01 00:05:00"]
    new = sorted(r["v"] for r in anti_join_new(batch, bounded, ["k"]).collect())
    assert new == sorted(r["v"] for r in anti_join_new(batch, target, ["k"]).collect()) == [2, 3]
    # a batch whose key column is all NULL cannot match anything
    nulls = batch.filter("k IS NULL")
    assert bound_target(target, nulls, "k").count() == 0


def test_load_inbox_join_route_for_many_files(spark, monkeypatch):
    import os

    import voltline.plans.load as pl

    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/inbox/sub")
    _write(f"{d}/inbox", "PUBLIC_DVD_DISPATCHPRICE_202601010000.CSV", HEAD + 'D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,1,0,1.5\n')
    _write(f"{d}/inbox/sub", "PUBLIC_DVD_DISPATCHPRICE_202601020000.CSV", HEAD + 'D,DISPATCH,PRICE,5,"2026/01/02 00:05:00",1,R1,1,0,2.5\n')
    _write(f"{d}/inbox", "PUBLIC_DVD_DISPATCHPRICE_202501010000.CSV", HEAD + 'D,DISPATCH,PRICE,5,"2025/01/01 00:05:00",1,R1,1,0,9.5\n')
    monkeypatch.setattr(pl, "PATH_LIST_MAX", 0)  # force the folder + join route
    opts = LoadOptions(start_year=2026, end_year=2026, months=(1,))
    _, report = load_inbox(spark, f"{d}/inbox", f"{d}/wh", f"{d}/ledger", opts)
    assert report.first()["rows_loaded"] == 2
    assert sorted(r["RRP"] for r in spark.read.parquet(f"{d}/wh/DISPATCHPRICE").collect()) == [1.5, 2.5]
