"""Run catalog queries in Spark and their SQL in DuckDB; compare row count,
column names and order-insensitive values (the driver's correctness gate).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
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
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


DIGITS = None if os.environ.get("ORACLE_EXACT") else 6


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (v if DIGITS is None else round(v, DIGITS))
    if isinstance(v, decimal.Decimal):
        return float(v) if DIGITS is None else round(float(v), DIGITS)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None) if v.tzinfo is None else v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = _canon(s_cols, s_rows)
    dc, dr = _canon(d_cols, d_rows)
    if sc != dc:
        res["status"] = f"columns differ: spark={sc} oracle={dc}"
    elif len(sr) != len(dr):
        res["status"] = "row count differs"
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"values differ, e.g. {bad}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from basketry.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "no-oracle")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
