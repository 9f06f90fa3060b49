"""Compare catalog queries with their DuckDB oracle SQL (row count, columns, sorted values).

Usage: python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, q):
    rel = con.sql(q)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)


def compare(spark, sf_dir: str, name: str, fn, q: str | None, con=None) -> tuple[bool, str]:
    t0 = time.time()
    sc, srows = rows_of_spark(fn(spark, sf_dir))
    t1 = time.time()
    if q is None:
        return True, f"{name}: rows={len(srows)} (no oracle) spark={t1 - t0:.1f}s"
    con = con or duck(sf_dir)
    dc, drows = rows_of_duck(con, q)
    t2 = time.time()
    ok = sc == dc and srows == drows
    msg = f"{name}: spark_rows={len(srows)} duck_rows={len(drows)} cols_ok={sc == dc} ok={ok} " \
          f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s"
    if not ok:
        if sc != dc:
            msg += f"\n  spark cols {sc}\n  duck cols  {dc}"
        else:
            ss, ds = set(srows), set(drows)
            msg += f"\n  only spark: {sorted(ss - ds, key=repr)[:3]}\n  only duck: {sorted(ds - ss, key=repr)[:3]}"
    return ok, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from quarry.session import get_spark
    spark = get_spark()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        ok, msg = compare(spark, sf_dir, name, qs[name], orc.get(name), con)
        bad += not ok
        print(msg, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
