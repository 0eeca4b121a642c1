"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
Compares row count, column names and an order-insensitive value hash
(columns sorted by name, doubles rounded to 6 digits).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ludora.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir, verbose=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(s_rows), "status": "no-oracle", "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    out["status"] = "match" if (hs == hd and len(s_rows) == len(d_rows)) else "MISMATCH"
    if out["status"] != "match" and verbose:
        only_s = sorted(set(ls) - set(ld))[:5]
        only_d = sorted(set(ld) - set(ls))[:5]
        out["only_spark"] = only_s
        out["only_duck"] = only_d
        out["cols"] = sorted(s_cols)
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    from ludora.plans.catalog import QUERIES
    from ludora.session import get_spark
    spark = get_spark()
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir, verbose=True)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
