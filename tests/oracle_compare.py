"""Run registered Spark queries next to their DuckDB oracle and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and types, and the multiset of rows
(order-free).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    if sorted(cols) != sorted(dcols):
        return False, f"columns differ: spark={cols} duck={dcols}"
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    if stypes != dtypes:
        diff = {c: (stypes[c], dtypes[c]) for c in cols if stypes[c] != dtypes[c]}
        return False, f"column types differ (spark, duck): {diff}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row:\n  spark={x}\n  duck ={y}"
    return True, f"{len(srows)} rows ok (spark {t1 - t0:.1f}s, duck {t2 - t1:.2f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tripmart.session import get_spark

    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            print(f"-- {name}: no oracle (rows-only)")
            continue
        try:
            ok, msg = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
