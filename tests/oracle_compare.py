"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares row count, column names and the order-insensitive multiset of rows
(floats compared exactly, timestamps as text).
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df.reindex(sorted(df.columns), axis=1).copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else str(v))
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s = sdf.toPandas()
    t1 = time.time()
    o = con.execute(E.oracle_sql()[name]).df()
    t2 = time.time()
    res = {"query": name, "spark_rows": len(s), "oracle_rows": len(o),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    res["columns_match"] = sorted(s.columns) == sorted(o.columns)
    if not res["columns_match"]:
        res["cols"] = (sorted(set(s.columns) - set(o.columns)), sorted(set(o.columns) - set(s.columns)))
        res["match"] = False
        return res
    for c in s.columns:  # timestamps: same text form on both sides
        if str(o[c].dtype).startswith("datetime"):
            o[c] = o[c].astype("datetime64[us]")
            s[c] = pd.to_datetime(s[c]).astype("datetime64[us]")
    ns, no = _norm(s), _norm(o)
    res["match"] = len(ns) == len(no) and ns.equals(no)
    if not res["match"] and len(ns) == len(no):
        diff = (ns != no) & ~(ns.isna() & no.isna())
        bad_cols = [c for c in ns.columns if diff[c].any()]
        res["bad_cols"] = {c: int(diff[c].sum()) for c in bad_cols}
        if bad_cols:
            i = diff[bad_cols[0]].idxmax()
            res["example"] = {"spark": ns.loc[i, bad_cols].to_dict(), "oracle": no.loc[i, bad_cols].to_dict()}
    return res


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(E.queries())
    from tripflow.session import local_session
    spark = local_session(checkpoint=tempfile.mkdtemp(prefix="tripflow-ckpt-"))
    con = duck(sf_dir)
    ok = True
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"query": n, "match": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok &= bool(r.get("match"))
        print(r, flush=True)
    print("ALL MATCH" if ok else "MISMATCHES")


if __name__ == "__main__":
    main()
