"""F1-F4 on the file names of FIXTURES.md §2 and the original tests' names."""

import pytest
from pyspark.sql import functions as F

from voltline.functions.names import in_period, period_first8, period_strict, route_table, strip_extension

CASES = [
    # name, route (original), route decoded (V2), strict (y, m), first-8 (y, m)
    ("PUBLIC_DVD_DISPATCHPRICE_202407010000.CSV", "DISPATCHPRICE", "DISPATCHPRICE", (2024, 7), (2024, 7)),
    ("public_dvd_rooftop_pv_actual_20240701.csv", "ROOFTOP_PV_ACTUAL", "ROOFTOP_PV_ACTUAL", (2024, 7), (2024, 7)),
    ("PUBLIC_DVD_DISPATCHPRICE_20240701000000.CSV", "OTHER_DATA", "OTHER_DATA", (2024, 7), (2024, 7)),
    ("PUBLIC_ARCHIVE#TRADINGPRICE#FILE01#202601010000.CSV", "TRADINGPRICE", "TRADINGPRICE", (2026, 1), (2026, 1)),
    ("PUBLIC_ARCHIVE%23TRADINGPRICE%23FILE01%23202601010000.CSV", "OTHER_DATA", "TRADINGPRICE", (2026, 1), (2026, 1)),
    ("DISPATCHPRICE.csv", "DISPATCHPRICE", "DISPATCHPRICE", (None, None), (None, None)),
    ("REPORT_20261301_20260201.CSV", "OTHER_DATA", "OTHER_DATA", (2026, 2), (2026, 13)),
    ("REPORT_20260001.CSV", "OTHER_DATA", "OTHER_DATA", (None, None), (2026, 0)),
    ("99992026010100.CSV", "OTHER_DATA", "OTHER_DATA", (9992, 2), (9999, 20)),
    # the original's own test names: the code routes all of them to the catch-all
    ("SCADA_DATA.csv", "OTHER_DATA", "OTHER_DATA", (None, None), (None, None)),
    ("price.csv", "OTHER_DATA", "OTHER_DATA", (None, None), (None, None)),
    ("unknown.csv", "OTHER_DATA", "OTHER_DATA", (None, None), (None, None)),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "name string")
    s, f8 = period_strict("name"), period_first8("name")
    rows = df.select(
        "name", route_table("name").alias("r"), route_table("name", decode=True).alias("rd"),
        s["year"].alias("sy"), s["month"].alias("sm"), f8["year"].alias("fy"), f8["month"].alias("fm"),
    ).collect()
    return {r["name"]: r for r in rows}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_file_name_rules(results, case):
    name, route, route_dec, strict, first8 = case
    r = results[name]
    assert r["r"] == route
    assert r["rd"] == route_dec
    assert (r["sy"], r["sm"]) == strict
    assert (r["fy"], r["fm"]) == first8


def test_strip_extension(spark):
    names = ["a.b.csv", ".csv", "..a.csv", "a.", "plain"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(strip_extension("n")).collect()]
    assert got == ["a.b", ".csv", "..a", "a", "plain"]


def test_period_window_unknown_passes(spark):
    df = spark.createDataFrame([(None, None), (2026, 1), (2026, 4), (2025, 1), (2026, 0), (0, 1)], "y int, m int")
    strict = [r[0] for r in df.select(in_period("y", "m", 2026, 2026, [1, 2, 3])).collect()]
    assert strict == [True, True, False, False, False, False]
    loose = [r[0] for r in df.select(in_period("y", "m", 2026, 2026, [1, 2, 3], zero_is_unknown=True)).collect()]
    assert loose == [True, True, False, False, True, True]
