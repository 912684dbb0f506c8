"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
column names, row counts and order-insensitive values.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, f"{round(v, 9):.9f}")
    if isinstance(v, int):
        return (2, f"{float(v):.9f}")
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (4, str(v))


def canon(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ ({sum(a != b for a, b in zip(sr, dr))} rows), e.g. {diff}"
    return True, f"{len(sr)} rows, spark {t1 - t0:.2f}s"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from winnow.session import local_session

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
