"""Q1, Q2 over a warehouse: names of stored tables in SQL."""

import os
import tempfile

import pytest

from voltline.plans.sql import list_tables, run_sql, stored_names


@pytest.fixture(scope="module")
def warehouse(spark):
    d = tempfile.mkdtemp(prefix="run-") + "/wh [1]"
    spark.range(3).selectExpr("id AS k", "id * 10 AS v").write.parquet(f"{d}/PRICE")
    spark.range(5).selectExpr("id AS k", "concat('n', id) AS name").write.parquet(f"{d}/Unit")
    spark.range(1).write.parquet(f"{d}/_rejects")
    return d


def test_names_and_their_scopes(spark):
    names = lambda q: stored_names(spark, q)
    assert names("SELECT * FROM a JOIN b USING (k), db.c, parquet.`/x`") == {"a", "b"}
    assert names("WITH a AS (SELECT 1), c AS (SELECT * FROM A JOIN d) SELECT * FROM a, C, e") == {"d", "e"}
    assert names("WITH a AS (SELECT * FROM a) SELECT * FROM a") == {"a"}
    assert names("SELECT * FROM (WITH a AS (SELECT 1) SELECT * FROM a) x, a") == {"a"}
    assert names("SELECT (SELECT max(k) FROM s) FROM t WHERE EXISTS (SELECT 1 FROM u WHERE k IN (SELECT k FROM w)) ORDER BY (SELECT 1 FROM z)") == {"s", "t", "u", "w", "z"}
    assert names("SELECT * FROM a UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM c)") == {"a", "b", "c"}
    assert names("WITH RECURSIVE r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r WHERE n < 3) SELECT * FROM r") == set()


def test_stored_tables_by_name(spark, warehouse):
    get = lambda q, **k: [tuple(r) for r in run_sql(spark, q, warehouse=warehouse, **k).collect()]
    assert get("SELECT price.k, u.name FROM price JOIN UNIT u ON u.k = PRICE.k ORDER BY price.k DESC -- all\n;") == [(2, "n2"), (1, "n1"), (0, "n0")]
    assert get("WITH Unit AS (SELECT 7 AS k) SELECT * FROM unit") == [(7,)]
    assert get("SELECT count(*) FROM PRICE TABLESAMPLE (100 PERCENT) WHERE '{x}' = concat('{', 'x', '}')") == [(3,)]
    other = spark.createDataFrame([(1,)], "k long")
    assert get("SELECT name FROM unit JOIN {mine} m ON m.k = unit.k", mine=other) == [("n1",)]
    assert get("SELECT count(*) FROM {PRICE}", PRICE=other) == [(1,)]  # a frame that is handed in wins
    spark.range(9).createOrReplaceTempView("session_view")
    before = {t.name for t in spark.catalog.listTables()}
    assert get("SELECT count(*) FROM session_view JOIN price ON price.k = session_view.id") == [(3,)]
    assert {t.name for t in spark.catalog.listTables()} == before
    spark.catalog.dropTempView("session_view")
    for bad in ("INSERT INTO PRICE VALUES (1, 2)", "DROP TABLE PRICE", "CREATE TABLE x AS SELECT * FROM PRICE"):
        with pytest.raises(PermissionError):
            run_sql(spark, bad, warehouse=warehouse)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        run_sql(spark, "SELECT * FROM missing", warehouse=warehouse)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        run_sql(spark, "SELECT * FROM _rejects", warehouse=warehouse)


def test_filters_and_columns_reach_the_stored_files(spark, warehouse):
    plan = run_sql(spark, "SELECT name FROM unit WHERE k = 3", warehouse=warehouse)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,3)" in plan and "ReadSchema: struct<k:bigint,name:string>" in plan


def test_tables_are_listed_by_folder(spark, warehouse):
    assert [r.table_name for r in list_tables(spark, warehouse).collect()] == ["PRICE", "Unit"]
    assert list_tables(spark, warehouse + "/none").count() == 0
    os.makedirs(f"{warehouse}/unit", exist_ok=True)
    spark.range(2).write.mode("overwrite").parquet(f"{warehouse}/unit")
    with pytest.raises(ValueError, match="could be any of"):
        run_sql(spark, "SELECT * FROM UNIT", warehouse=warehouse)
    assert run_sql(spark, "SELECT count(*) FROM unit", warehouse=warehouse).first()[0] == 2
