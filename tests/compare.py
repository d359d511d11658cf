"""Runs registered queries and their checking SQL side by side."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v) + 0.0
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(type(v)), v) for v in r])


def differences(spark, con, name: str, function, sql: str, sf_dir: str) -> tuple[str | None, float, float, int]:
    t0 = time.time()
    df = function(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    t2 = time.time()
    a_cols, a = _rows(df.columns, got)
    b_cols, b = _rows(names, want)
    message = None
    if a_cols != b_cols:
        message = f"columns {a_cols} != {b_cols}"
    elif len(a) != len(b):
        message = f"{len(a)} rows != {len(b)}"
    elif not a:
        message = "no rows"
    else:
        for x, y in zip(a, b):
            bad = [(c, u, v) for c, u, v in zip(a_cols, x, y) if u != v]
            if bad:
                close = all(isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9) for _, u, v in bad)
                message = ("only nearly equal " if close else "") + f"{bad[:3]} in {dict(zip(a_cols, x))}"[:600]
                break
    return message, t1 - t0, t2 - t1, len(a)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    from plotstats.session import build_session

    sf, *only = sys.argv[1:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT"):
        spark.conf.set("plotstats.hot.rows", os.environ["HOT"])
    con = connect(f"{DATA}/sf{sf}")
    checks = oracle_sql()
    bad = 0
    for name, function in queries().items():
        if only and name not in only:
            continue
        try:
            if name in checks:
                message, s, d, n = differences(spark, con, name, function, checks[name], f"{DATA}/sf{sf}")
            else:
                t = time.time()
                rows = function(spark, f"{DATA}/sf{sf}").collect()
                message, s, d, n = None, time.time() - t, 0.0, len(rows)
                print("   ", rows[:4])
        except Exception as e:  # report and go on with the next query
            message, s, d, n = f"{type(e).__name__}: {str(e)[:700]}", 0, 0, 0
        bad += message is not None
        print(f"{'ok ' if message is None else 'BAD'} {name:24} spark {s:6.2f}s duckdb {d:6.2f}s rows {n} {message or ''}", flush=True)
    print("bad:", bad)
