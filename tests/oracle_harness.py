"""Spark-vs-DuckDB comparison used by the tests and by hand.

Mirrors the driver's gate: same sorted column names, same row count, same
order-insensitive multiset of values.  Types are reported side by side.

    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck_connect(sf_dir: str):
    import duckdb
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
            return "nan"
        return round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


_SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                  "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampType": "TIMESTAMP"}


def spark_rows(df):
    cols = df.columns
    types = {f.name: _SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString().upper())
             for f in df.schema.fields}
    rows = [tuple(r) for r in df.collect()]
    return cols, types, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    types = dict(zip(cols, [str(t) for t in rel.types]))
    rows = rel.fetchall()
    return cols, types, rows


def compare(spark_res, duck_res) -> dict:
    scols, stypes, srows = spark_res
    dcols, dtypes, drows = duck_res
    out = {"cols_match": sorted(scols) == sorted(dcols), "spark_rows": len(srows), "duck_rows": len(drows)}
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(scols), sorted(dcols)
        out["ok"] = False
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in drows)
    out["values_match"] = sc == dc
    out["type_mismatch"] = {c: (stypes[c], dtypes[c]) for c in order if stypes[c] != dtypes[c]}
    if not out["values_match"]:
        only_s = list((sc - dc).items())[:3]
        only_d = list((dc - sc).items())[:3]
        out["cols"] = order
        out["only_spark"], out["only_duck"] = only_s, only_d
    out["ok"] = out["values_match"] and out["spark_rows"] == out["duck_rows"] and not out["type_mismatch"]
    return out


def run(names=None, sf_dir="/root/testdata/sf0.01", spark=None):
    import __spark_entry__ as E
    from vintagelake.session import get_session
    spark = spark or get_session(master="local[8]", shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sres = spark_rows(qs[name](spark, sf_dir))
            ts = time.time() - t0
            if name in orc:
                r = compare(sres, duck_rows(con, orc[name]))
            else:
                r = {"ok": None, "spark_rows": len(sres[2]), "note": "no oracle"}
            r["spark_sec"] = round(ts, 2)
        except Exception as ex:  # report and continue
            r = {"ok": False, "error": f"{type(ex).__name__}: {str(ex)[:600]}"}
        results[name] = r
        print(name, r, flush=True)
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sys.argv[2:] or None, sf)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad)
