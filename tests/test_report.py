"""P1-P10 on small literal report files (FIXTURES.md §3 and its variants)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltline.catalog import table_model
from voltline.operators.dedupe import dedupe_first
from voltline.operators.infer import apply_types, infer_types
from voltline.operators.report import analyse_header, parse_report

SAMPLE = """C,free text
I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,DISPATCHINTERVAL,INTERVENTION,RRP,LASTCHANGED
D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,20260101001,0,55.5,"2026/01/01 00:00:04"
D,DISPATCH,PRICE,5,"2026/01/01 00:05:00",1,R1,20260101001,0,99.9,"2026/01/01 00:00:09"
D,DISPATCH,PRICE,5,"2026/01/01 00:10:00",1,R1,20260101002,0,,"2026/01/01 00:05:03"
C,trailer
"""


def typed(parsed, layout=0):
    rows = parsed.strings(layout)
    cols = [c for c in rows.columns if not c.startswith("_")]
    return apply_types(rows, infer_types(rows, cols))


def status_of(parsed):
    return {r["file_name"]: r["status"] for r in parsed.file_status().collect()}


def test_sample_parses_and_dedupes(make_lines):
    p = parse_report(make_lines({"PUBLIC_DVD_DISPATCHPRICE_202601010000.CSV": SAMPLE}))
    t = typed(p)
    assert len(t.collect()) == 3
    types = {f.name: f.dataType for f in t.schema.fields}
    assert types["SETTLEMENTDATE"] == T.TimestampNTZType()
    assert types["RUNNO"] == T.LongType() and types["RRP"] == T.DoubleType()
    assert types["LASTCHANGED"] == T.StringType()  # neither DATE nor TIME in the name
    key = list(table_model("DISPATCHPRICE").primary_key)
    d = dedupe_first(t, key, ["_source_file", "_block_start", "_line_id"]).orderBy("SETTLEMENTDATE").collect()
    assert [r["RRP"] for r in d] == [55.5, None]


def test_status_edges(make_lines):
    files = {
        "no_header.CSV": "D,A,B,1,x\n",
        "no_data.CSV": "I,A,B,1,x\n",
        "blank_name.CSV": "I,A,B,1,x,,z\nD,A,B,1,1,2,3\n",
        "dup_name.CSV": "I,A,B,1,x,x\nD,A,B,1,1,2\n",
        "first_wide.CSV": "I,A,B,1,x,y\nD,A,B,1,1,2,3\nD,A,B,1,1,2\n",
        "later_wide.CSV": "I,A,B,1,x,y\nD,A,B,1,1,2\nD,A,B,1,1,2,3\n",
        "later_narrow.CSV": "I,A,B,1,x,y\nD,A,B,1,1,2\nD,A,B,1,1\n",
        "quoted.CSV": 'I,A,B,1,x,y\nD,A,B,1,"a,b",2\nD,A,B,1,"say ""hi""",\n',
        "lower_d.CSV": "I,A,B,1,x,y\nd,A,B,1,1,2\nD,A,B,1,3,4\n D,A,B,1,5,6\n",
    }
    st = status_of(parse_report(make_lines(files)))
    assert st["no_header.CSV"] == "no_header_or_data"
    assert st["no_data.CSV"] == "no_header_or_data"
    assert st["blank_name.CSV"] == "bad_header"
    assert st["dup_name.CSV"] == "bad_header"
    assert st["first_wide.CSV"] == "width_mismatch"
    assert st["later_wide.CSV"] == "row_too_wide"
    assert st["later_narrow.CSV"] == "ok"
    assert st["quoted.CSV"] == "ok"
    assert st["lower_d.CSV"] == "ok"


def test_values_quotes_nulls_and_padding(make_lines):
    files = {"f.CSV": 'I,A,B,1,x,y\nD,A,B,1,"a,b",NA\nD,A,B,1,"say ""hi""",null\nD,A,B,1,007\n'}
    p = parse_report(make_lines(files))
    rows = p.strings(0).orderBy("_line_id").collect()
    assert [(r["x"], r["y"]) for r in rows] == [("a,b", None), ('say "hi"', None), ("007", None)]


def test_header_offset_rules():
    lay = analyse_header(0, "I,DISPATCH,PRICE, 5 ,A,B")
    assert (lay.start_col, lay.names) == (4, ("A", "B"))
    lay = analyse_header(0, "I,A,B")  # no digit field: only the tag is dropped
    assert (lay.start_col, lay.names) == (1, ("A", "B"))
    assert analyse_header(0, "I,A,NA,1,x").problem is not None


def test_two_sections_last_vs_nearest(make_lines):
    text = "I,A,B,1,x,y\nD,A,B,1,1,2\nI,A,C,2,x,z\nD,A,C,2,3,4\n"
    last = parse_report(make_lines({"f.CSV": text}), sections="last")
    assert len(last.layouts) == 1 and last.layouts[0].names == ("x", "z")
    assert sorted(r["z"] for r in last.strings(0).collect()) == ["2", "4"]
    near = parse_report(make_lines({"f.CSV": text}), sections="nearest")
    got = {lay.names: [tuple(r)[3:] for r in near.strings(lay).collect()] for lay in near.layouts}
    assert got == {("x", "y"): [("1", "2")], ("x", "z"): [("3", "4")]}


def test_inference_rules(make_lines):
    files = {"f.CSV": "I,A,B,1,i,f,b,s,e,SOME_TIME,D_DATE\n"
                      "D,A,B,1,1,1.5,True,x,,2999/01/01 00:00:00,2026-01-02\n"
                      "D,A,B,1,,2,false,1,,20260101,2026/01/03 10:00:00\n"}
    p = parse_report(make_lines(files))
    rows = p.strings(0)
    cols = [c for c in rows.columns if not c.startswith("_")]
    t = infer_types(rows, cols)
    assert t["i"] == T.LongType() and t["f"] == T.DoubleType() and t["b"] == T.BooleanType()
    assert t["s"] == T.StringType() and t["e"] == T.DoubleType()
    assert t["SOME_TIME"] == T.TimestampNTZType() and t["D_DATE"] == T.TimestampNTZType()
    out = apply_types(rows, t).orderBy("_line_id").collect()
    assert out[0]["SOME_TIME"].year == 2999  # far-future kept (V7)
    assert out[1]["SOME_TIME"] is None       # integer text in a TIME column is not a time
    assert [r["D_DATE"].day for r in out] == [2, 3]  # mixed layouts both parse (V7)


def test_invalid_utf8_dropped(spark):
    from voltline.functions.text import drop_invalid_utf8

    df = spark.createDataFrame([(bytearray(b"9.\xff5"),)], "b binary")
    assert df.select(drop_invalid_utf8(F.col("b").cast("string"))).first()[0] == "9.5"


def _scans(df):
    """Locations of the file scans of a frame's plan."""
    todo, found = [df._jdf.queryExecution().sparkPlan()], []
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.simpleString(1 << 20))
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def _many(n):
    """Files of n headers: names in turning order, quoted values, one header that names a column twice."""
    files = {}
    for i in range(n):
        names = ["a", f"b{i % 5}", "c"] if i % 2 else ["c", "A"]
        values = [str(i), f'"x, {i}"', f"{i}.5"] if i % 2 else [f"{i}.5", str(i)]
        if i == 3:
            names[2] = "a"
        files[f"{'PUBLIC_DVD_TRADINGPRICE_20260101%04d' % i if i % 3 else 'other%d' % i}.CSV"] = f"I,R,S,{i},{','.join(names)}\nD,R,S,{i},{','.join(values)}\nD,R,S,{i},,\n" if len(names) == 2 else f"I,R,S,{i},{','.join(names)}\nD,R,S,{i},{','.join(values)}\n"
    return files


def test_any_number_of_layouts_is_one_scan_of_a_table(spark, make_lines, monkeypatch):
    from voltline.functions.names import route_table
    from voltline.operators import report

    monkeypatch.setattr(report, "LOCAL_LAYOUTS", 20)
    for n in (6, 50):
        lines = make_lines(_many(n))
        parsed = parse_report(lines)
        staged = parsed.stage(lines.select("source_file", route_table("file_name").alias("table_name")).distinct())
        assert staged.n_layouts == n and set(staged.columns) == {"tradingprice", "other_data"}
        for name in staged.columns:
            scans = _scans(staged.rows(name))
            # its own rows, and the registry where it is written
            assert len(scans) == 1 + (n > report.LOCAL_LAYOUTS) and sum("PartitionFilters: [isnotnull(_table" in s for s in scans) == 1
        status = {r.file_name: r.status for r in parsed.file_status().collect()}
        assert [k for k, v in status.items() if v != "ok"] == ["other3.CSV"] and status["other3.CSV"] == "bad_header"
        got = sorted((r["_source_file"].split("/")[-1], r["_line_id"], r["A" if "A" in staged.columns[t] else "a"], r["c"]) for t in staged.columns for r in staged.rows(t).collect())
        want = []
        for name, text in _many(n).items():
            i = int(text.split(",")[3])
            if i != 3:
                want.append((name, 1, str(i), f"{i}.5"))
                if i % 2 == 0:
                    want.append((name, 2, None, None))
        assert got == sorted(want)
        b = {r["_source_file"].split("/")[-1]: [r[c] for c in staged.columns["tradingprice"] if c.startswith("b") and r[c]] for r in staged.rows("tradingprice").collect()}
        assert b["PUBLIC_DVD_TRADINGPRICE_202601010001.CSV"] == ["x, 1"] and b["PUBLIC_DVD_TRADINGPRICE_202601010004.CSV"] == []


def test_staged_rows_equal_the_rows_of_one_layout(make_lines):
    text = 'I,A,B,1,x,y,z\nD,A,B,1,"a,b","say ""hi""",\nD,A,B,1,plain, sp ,NA\nD,A,B,1,"",é,"q"\nD,A,B,1,1,"un"x,2\n'
    lines = make_lines({"f.CSV": text})
    parsed = parse_report(lines)
    staged = parsed.stage(lines.selectExpr("source_file", "'T' AS table_name").distinct())
    assert sorted(map(str, staged.rows("t").collect())) == sorted(map(str, parsed.strings(0).collect()))


def test_more_layouts_than_ever_and_one_is_bad(make_lines):
    n = 1001
    files = {f"f{i}.CSV": f"I,A,B,{i},x,{'x' if i == 7 else 'y'}\nD,A,B,{i},{i},v\n" for i in range(n)}
    lines = make_lines(files)
    parsed = parse_report(lines)
    status = {r.file_name: r.status for r in parsed.file_status().collect()}
    assert len(status) == n and {k: v for k, v in status.items() if v != "ok"} == {"f7.CSV": "bad_header"}
    staged = parsed.stage(lines.selectExpr("source_file", "'T' AS table_name").distinct())
    assert staged.columns == {"t": ["x", "y"]} and staged.rows("t").selectExpr("count(*)", "sum(x)").first()[:] == (n - 1, sum(range(n)) - 7)


def test_widths_are_added_up_without_sorting_lines(spark):
    from voltline.operators.report import section_widths

    h = (0, -1)
    rows = [("f", "f", h, 7, 0, "D,1"), ("f", "f", h, 7, 9, "D,1,2,3"), ("f", "f", h, 0, 5, "D,1,2"), ("f", "f", h, 0, 6, "D"), ("f", "f", None, 0, None, "D,x"),
            ("g", "g", h, 0, 3, "D,1"), ("g", "g", h, 0, None, 'D,"a,b",2'), ("g", "g", h, None, 4, "D")]
    data = spark.createDataFrame(rows, "source_file string, file_name string, h_pos struct<b:bigint,l:bigint>, block_start bigint, line_id bigint, value string")
    found = section_widths(data)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.source_file, r.h_pos is None): (r.rows, r.first_width, r.max_width) for r in found.collect()}
    assert got == {("f", False): (4, 3, 4), ("f", True): (1, 2, 2), ("g", False): (3, 1, 3)}


def test_rules_of_inference_stand_in_the_plan_once(spark):
    from voltline.operators.infer import column_classes

    df = spark.createDataFrame([("1", "2.5", None, "True", "1996/01/02", "9" * 19, "x")] * 3, "a string, b string, c string, d string, e string, f string, g string")
    plan = lambda cols: column_classes(df, cols)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")
    assert plan(df.columns) == plan(["a"])
    assert [tuple(r) for r in column_classes(df, df.columns).orderBy("i").collect()] == [(0, 3, 3), (1, 3, 2), (2, 0, 7), (3, 3, 4), (4, 3, 0), (5, 3, 0), (6, 3, 0)]
    assert {k: v.simpleString() for k, v in infer_types(df, df.columns).items()} == dict(
        a="bigint", b="double", c="double", d="boolean", e="string", f="string", g="string")
    assert {k: v.simpleString() for k, v in infer_types(df.limit(0), ["a"]).items()} == {"a": "double"}


def test_class_of_odd_values(spark):
    from voltline.operators.infer import value_class

    texts = {None: 7, "": 0, "-": 0, ".": 0, "-.": 0, "5.": 2, "-.5": 2, "+.5": 2, "--5": 0, "-5": 3, " 5 ": 3, "5\n": 3, "9" * 18: 3, "9" * 19: 0, "9223372036854775807": 3,
             "-9223372036854775808": 3, "0" * 25: 3, "1e5": 2, "1.5e5": 2, "1e999": 2, "1d": 0, "1.5d": 0, "0x1p3": 0, "inf": 2, "-infinity": 2, "NaN": 2, "TRUE": 4, "tRUE": 0, "1/2": 0, "1:2": 0, "1.2.3": 0}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", value_class(F.col("t")).alias("k"))
    assert {r.t: r.k for r in df.collect()} == texts


def test_split_and_csv_rows_of_one_layout(make_lines):
    text = "I,A,B,1,x,y,z\nD,A,B,1, 1 ,,NA\nD,A,B,1,\"a,\"\"b\"\"\",2,\nD,A,B,1,é\n"
    rows = parse_report(make_lines({"F.CSV": text})).strings(0, lineage=False).collect()
    assert sorted((tuple(r) for r in rows), key=str) == sorted([(" 1 ", None, None), ('a,"b"', "2", None), ("é", None, None)], key=str)
