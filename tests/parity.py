"""Spark-vs-DuckDB parity helpers (also runnable as a script).

``python tests/parity.py [sf_dir] [key ...]`` runs each registered query in
Spark and its oracle SQL in DuckDB and prints row counts and whether the
order-insensitive values agree.
"""

from __future__ import annotations

import math
from collections import Counter
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


EXACT = os.environ.get("PARITY_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    vals = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return cols, vals


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(spark, sf_dir, key, query, sql, con=None):
    con = con or duck(sf_dir)
    s_cols, s_rows = spark_rows(query(spark, sf_dir))
    d_cols, d_rows = duck_rows(con, sql)
    sc, sv = canon(s_cols, s_rows)
    dc, dv = canon(d_cols, d_rows)
    match = sv == dv
    diff = []
    if not match:  # multiset difference, linear time
        a, b = Counter(sv), Counter(dv)
        diff = list((a - b).elements())[:3] + ["|"] + list((b - a).elements())[:3]
    return {"key": key, "spark_rows": len(sv), "duck_rows": len(dv), "cols_match": sc == dc,
            "values_match": match, "spark_cols": sc, "duck_cols": dc, "diff": diff}


if __name__ == "__main__":
    import __spark_entry__ as entry

    from forumlens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf)
    n_ok = n_bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            n = qs[k](spark, sf).count()
            print(f"{k:32s} rows-only {n}")
            continue
        r = compare(spark, sf, k, qs[k], sqls[k], con)
        ok = r["cols_match"] and r["values_match"] and r["spark_rows"] == r["duck_rows"]
        n_ok, n_bad = n_ok + ok, n_bad + (not ok)
        print(f"{k:32s} {'OK ' if ok else 'BAD'} spark={r['spark_rows']} duck={r['duck_rows']}"
              + ("" if ok else f" cols={r['spark_cols']} vs {r['duck_cols']} diff={r['diff']}"))
    print(f"summary: {n_ok} match, {n_bad} differ")
