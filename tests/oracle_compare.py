"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]``.  Prints one
line per query: rows on each side, column names, and whether the sorted
row multisets are equal (doubles compared to 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return v if EXACT else round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return [cols[i] for i in order], out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols = df.columns
    res = con.sql(sql)
    dcols = res.columns
    drows = res.fetchall()
    t2 = time.time()
    sc, s = canon(srows, scols)
    dc, d = canon(drows, dcols)
    ok = sc == dc and s == d
    detail = ""
    if os.environ.get("TYPES") == "1":
        stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        dtypes = dict(zip(dcols, [str(t) for t in res.types]))
        detail += " types: " + ", ".join(f"{c}={stypes[c]}/{dtypes.get(c)}" for c in scols) + " "
    if not ok:
        if sc != dc:
            detail = f"cols spark={sc} duck={dc}"
        else:
            ss, dd = set(s), set(d)
            only_s = list(ss - dd)[:3]
            only_d = list(dd - ss)[:3]
            detail = f"only_spark={only_s} only_duck={only_d}"
    print(f"{name:28s} spark={len(srows):7d} duck={len(drows):7d} {'OK ' if ok else 'BAD'} "
          f"t_spark={t1 - t0:6.2f}s t_duck={t2 - t1:6.2f}s {detail}"[:2000], flush=True)
    return ok


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from chirpwave.session import local_session
    import __spark_entry__ as E
    spark = local_session()
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            if not compare(spark, con, name, fn, os_[name], sf_dir):
                bad.append(name)
        except Exception as e:  # report and continue
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:800]}", flush=True)
            bad.append(name)
    print("BAD:", bad)


if __name__ == "__main__":
    main()
