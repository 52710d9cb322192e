"""Run catalog queries on Spark and their SQL on DuckDB; compare like the driver does.

Compares column names (sorted), row count and the multiset of rows (values
normalised: decimals by value, floats exact, dates ISO).  Usage:

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import collections
import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerlake.fixtures import DRIVER_TABLES  # noqa: E402
from ledgerlake.plans import load_all  # noqa: E402
from ledgerlake.session import get_session  # noqa: E402

EXTRA_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("d", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("D", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return norm(tuple(v))
    return (type(v).__name__, v)


def duck(sf: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES + EXTRA_TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_diffs(sdf, rel) -> list:
    """Columns whose Spark type and DuckDB type differ (decimal precision/scale included)."""
    duck = {c: str(t).upper() for c, t in zip(rel.columns, rel.types)}
    out = []
    for c, t in sdf.dtypes:
        want = _SPARK_TO_DUCK.get(t, t.upper())
        if duck.get(c) != want:
            out.append((c, t, duck.get(c)))
    return out


def check(spark, con, q, sf: str, show: int = 3) -> dict:
    t0 = time.time()
    sdf = q.fn(spark, sf)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": q.name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if q.sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(q.sql)
    td = type_diffs(sdf, rel)
    if td:
        res["type_diffs"] = td
    dcols = rel.columns
    drows = rel.fetchall()
    res["duck_rows"] = len(drows)
    res["duck_sec"] = round(time.time() - t1, 2)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = collections.Counter(tuple(norm(r[i]) for i in si) for r in srows)
    dc = collections.Counter(tuple(norm(r[i]) for i in di) for r in drows)
    if sc == dc:
        res["status"] = "OK"
    else:
        only_s = list((sc - dc).elements())[:show]
        only_d = list((dc - sc).elements())[:show]
        res["status"] = "VALUES"
        res["cols"] = order
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    cat = load_all()
    names = a.names or list(cat)
    spark = get_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(a.sf)
    bad = 0
    for n in names:
        try:
            r = check(spark, con, cat[n], a.sf)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:600]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
