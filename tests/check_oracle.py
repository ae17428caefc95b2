"""Run registered queries beside their SQL on one data folder: python tests/check_oracle.py SF [name ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normalise(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return "~"
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)
        return str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in row) for row in df.itertuples(index=False, name=None))


def compare(spark, con, name, fn, sql, sf_dir):
    got = fn(spark, sf_dir).toPandas()
    if sql is None:
        return len(got), None
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return len(got), f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = normalise(got), normalise(want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return len(got), f"{len(a)} rows vs {len(b)}; first differences {diff}"
    return len(got), ""


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


if __name__ == "__main__":
    from clearplate.registry import ORACLES, QUERIES
    from clearplate.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    names = [n for n in QUERIES if not sys.argv[2:] or any(n.startswith(p) for p in sys.argv[2:])]
    spark, con, bad = local_session(), connect(sf_dir), 0
    for n in names:
        t = time.time()
        try:
            rows, problem = compare(spark, con, n, QUERIES[n], ORACLES.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:1500]}"
        mark = "rows" if problem is None else "ok" if problem == "" else "BAD"
        bad += mark == "BAD"
        print(f"{mark:4} {n} rows={rows} {time.time() - t:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
