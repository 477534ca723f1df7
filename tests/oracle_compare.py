"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usable from pytest and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.date() if v == v.normalize() else v.to_pydatetime()
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    spark_pd = pd.DataFrame([r.asDict() for r in sdf.collect()], columns=sdf.columns)
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(spark_pd), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    duck_pd = con.execute(sql).df()
    res["oracle_rows"] = len(duck_pd)
    if sorted(spark_pd.columns) != sorted(duck_pd.columns):
        res["status"] = f"columns differ: {sorted(spark_pd.columns)} vs {sorted(duck_pd.columns)}"
        return res
    a, b = _rows(spark_pd), _rows(duck_pd)
    if a == b:
        res["status"] = "ok"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"values differ ({len(a)} vs {len(b)} rows), first: {diff}"
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from delaystats.session import build_session
    import __spark_entry__ as entry
    spark = build_session(8, 8)
    names = argv[2:] or list(entry.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
