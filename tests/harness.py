"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's gate: same column names (sorted), same row count, same multiset
of rows. Values are normalised only in representation (Decimal/float/date), never rounded.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return "D" + str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def compare(spark, con, name: str, fn, sql: str, sf_dir: str, show: int = 5):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
        return problems, len(s_rows), len(d_rows)
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if sc != dc:
        only_s = list((sc - dc).elements())[:show]
        only_d = list((dc - sc).elements())[:show]
        problems.append(f"values differ; cols={order}\n  spark-only={only_s}\n  duck-only={only_d}")
    return problems, len(s_rows), len(d_rows)


if __name__ == "__main__":
    import importlib
    import time

    sys.path.insert(0, ".")
    from opinio.session import local_session
    import tempfile

    sf_dir = "/root/testdata/sf0.01"
    names = sys.argv[1:]
    entry = importlib.import_module("__spark_entry__")
    import os
    no_ckpt = os.environ.get("HARNESS_NO_CHECKPOINT") == "1"
    spark = local_session(checkpoint_dir=None if no_ckpt else tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in (names or sorted(qs)):
        t0 = time.time()
        if n not in os_:
            try:
                rows = qs[n](spark, sf_dir).count()
                print(f"[rows-only] {n}: {rows} rows ({time.time() - t0:.1f}s)")
            except Exception as e:
                bad += 1
                print(f"[BAD] {n}: error {type(e).__name__}: {str(e)[:800]}")
            continue
        try:
            probs, ns, nd = compare(spark, con, n, qs[n], os_[n], sf_dir)
        except Exception as e:  # report and continue
            probs, ns, nd = [f"error: {type(e).__name__}: {str(e)[:800]}"], -1, -1
        status = "OK " if not probs else "BAD"
        bad += bool(probs)
        print(f"[{status}] {n}: spark={ns} duck={nd} ({time.time() - t0:.1f}s)")
        for p in probs:
            print("     ", p)
    print("failures:", bad)
