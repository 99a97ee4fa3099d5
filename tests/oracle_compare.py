"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Row count, column names and an order-insensitive comparison of values
(timestamps, dates, lists and floats normalised to comparable Python
values). Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    result = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        result["status"] = "no-oracle"
        return result
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    result["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        result["status"] = f"columns differ: {s_cols} vs {d_cols}"
        return result
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    if a == b:
        result["status"] = "match"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        result["status"] = "mismatch"
        result["spark_only"] = diff_a
        result["oracle_only"] = diff_b
    return result


def main(argv):
    from alertscope.session import session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = session(
        "oracle-compare", master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E

    names = argv[2:] or list(E.queries())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:400]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
