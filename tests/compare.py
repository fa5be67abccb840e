"""Run registered queries on Spark and their SQL on DuckDB, compare the results.

Usage: ``python -m tests.compare [sf_dir] [name ...]``.  The comparison is
order-insensitive: columns by name, rows as sorted tuples of canonical text.
Doubles are compared at 12 significant digits, or bit for bit with
``COMPARE_EXACT=1``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

EXACT = os.environ.get("COMPARE_EXACT") == "1"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v) if EXACT else f"{v:.12g}"
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if EXACT else f"{float(v):.12g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:10] if isinstance(v, dt.date) and not isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def canon_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["columns_match"]:
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
        res["match"] = False
        return res
    a, b = canon_rows(s_cols, s_rows), canon_rows(d_cols, d_rows)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_duck"] = sorted(sb - sa)[:3]
        res["cols"] = sorted(s_cols)
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tests.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir) if n in sqls else {"name": n, "match": None}
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "match": False, "error": repr(e)[:600]}
        bad += r.get("match") is False
        print(r, flush=True)
    print("MISMATCHES:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
