"""Local copy of the driver's correctness check: Spark query vs DuckDB SQL on the same Parquet files.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the values (columns sorted by name).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as entry
    from voltline.session import local_session

    spark = local_session()
    if os.environ.get("CHECK_TZ"):  # run under another session time zone (results must not change)
        spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            sp = time.time() - t0
            if name not in sqls:
                print(f"{name:24s} rows={len(rows):7d} (no oracle) {sp:6.1f}s")
                continue
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
            ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and digest(cols, rows) == digest(ocols, orows)
            bad += not ok
            print(f"{name:24s} {'OK ' if ok else 'BAD'} rows={len(rows):7d}/{len(orows):7d} {sp:6.1f}s"
                  + ("" if sorted(cols) == sorted(ocols) else f" cols {cols} vs {ocols}"))
            if not ok and sorted(cols) == sorted(ocols):
                sr = sorted(map(lambda r: tuple(_norm(x) for x in r), [tuple(r[cols.index(c)] for c in sorted(cols)) for r in rows]))
                orr = sorted(map(lambda r: tuple(_norm(x) for x in r), [tuple(r[ocols.index(c)] for c in sorted(cols)) for r in orows]))
                diff = [a for a in sr if a not in set(orr)][:3]
                print("   spark-only:", diff, "\n   oracle-only:", [a for a in orr if a not in set(sr)][:3])
        except Exception as exc:  # report and go on
            bad += 1
            print(f"{name:24s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
    print("failures:", bad)


if __name__ == "__main__":
    main()
