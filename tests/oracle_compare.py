"""Run registered queries against their DuckDB oracle SQL and compare.

Usable from pytest (``compare_query``) and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
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
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare_frames(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, sr = _rows(spark_pdf)
    oc, orows = _rows(oracle_pdf)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orows):
        return False, f"row count differs: spark={len(sr)} oracle={len(orows)}"
    for a, b in zip(sr, orows):
        for name, x, y in zip(sc, a, b):
            if x == y:
                continue
            if isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-6 * max(1.0, abs(y)):
                continue
            return False, f"value differs in {name}: spark={a} oracle={b}"
    return True, f"{len(sr)} rows"


def compare_query(spark, name: str, sf_dir: str, queries: dict, sqls: dict, con=None) -> tuple[bool, str, float]:
    t0 = time.time()
    spdf = queries[name](spark, sf_dir).toPandas()
    dt = time.time() - t0
    if name not in sqls:
        return True, f"{len(spdf)} rows (no oracle)", dt
    con = con or duck(sf_dir)
    opdf = con.execute(sqls[name]).df()
    ok, msg = compare_frames(spdf, opdf)
    return ok, msg, dt


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from seasonkit.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            ok, msg, dt = compare_query(spark, n, sf_dir, qs, sq, con)
        except Exception as e:  # report and continue
            ok, msg, dt = False, f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:32s} {dt:7.2f}s  {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
