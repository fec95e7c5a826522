"""Run registered queries in Spark and their oracle SQL in DuckDB; compare rows, columns and values.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, q, sql, sf_dir):
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(scols) == sorted(dcols)
    same = ok_cols and canon(srows, scols) == canon(drows, dcols)
    msg = f"{name}: spark {len(srows)} rows {t1 - t0:.1f}s | duckdb {len(drows)} rows {t2 - t1:.1f}s | "
    msg += "MATCH" if same else ("COLS " + str(sorted(set(scols) ^ set(dcols))) if not ok_cols else "VALUES DIFFER")
    print(msg, flush=True)
    if not same and ok_cols:
        a, b = canon(srows, scols), canon(drows, dcols)
        diff = [x for x in a if x not in set(b)][:3]
        print("  spark-only e.g.", diff)
        print("  duck-only  e.g.", [x for x in b if x not in set(a)][:3])
    return same


def main():
    import __spark_entry__ as E
    from batchlens.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = []
    for name, q in qs.items():
        if names and name not in names:
            continue
        if name not in sq:
            t0 = time.time()
            n = q(spark, sf_dir).count()
            print(f"{name}: rows-only {n} rows {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            if not compare(spark, con, name, q, sq[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
