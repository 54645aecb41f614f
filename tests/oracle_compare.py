"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.sources.tables import TABLE_NAMES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, int):
        return (1, float(v))
    return (3, str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def close(a, b) -> bool:
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1:
        return abs(a[1] - b[1]) <= 1e-6 * max(1.0, abs(a[1]), abs(b[1]))
    if a[0] == 2 and b[0] == 2 and len(a[1]) == len(b[1]):
        return all(close(x, y) for x, y in zip(a[1], b[1]))
    return False


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_recs = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_recs = res.fetchall()
    out = {"name": name, "spark_s": round(t1 - t0, 2), "rows": (len(s_recs), len(d_recs))}
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    a, b = rows_of(s_cols, s_recs), rows_of(d_cols, d_recs)
    if len(a) != len(b):
        out["status"] = "ROWCOUNT"
        return out
    if a == b:
        out["status"] = "EXACT"
        return out
    bad = [(x, y) for x, y in zip(a, b) if not close(x, y)]
    out["status"] = "CLOSE" if not bad else f"DIFF {len(bad)} e.g. {bad[0]}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tessera.plans.catalog import load_all
    from tessera.session import get_session

    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    reg = load_all()
    fails = 0
    for name, e in reg.items():
        if names and name not in names:
            continue
        if not e.sql:
            t0 = time.time()
            try:
                n = e.fn(spark, sf_dir).count()
                print(f"{name:40s} ROWS-ONLY rows={n} {time.time()-t0:.1f}s", flush=True)
            except Exception as ex:  # noqa: BLE001
                fails += 1
                print(f"{name:40s} ERROR {type(ex).__name__}: {str(ex)[:300]}", flush=True)
            continue
        try:
            r = compare(spark, con, name, e.fn, e.sql, sf_dir)
        except Exception as ex:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(ex).__name__}: {str(ex)[:400]}"}
        if r["status"] not in ("EXACT", "CLOSE"):
            fails += 1
        print(f"{name:40s} {r['status']} rows={r.get('rows')} {r.get('spark_s')}s", flush=True)
    print("FAILS", fails)
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
