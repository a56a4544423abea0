"""python tests/verify.py [--sf DIR] NAME... : registered queries against their SQL in DuckDB; without names, all."""

import glob
import os
import sys
import time
from decimal import Decimal

import duckdb
import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tallyspark.session import make_session  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        files = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{files}')")
    return con


def plain(value):
    if value is None:
        return "~"
    if isinstance(value, (list, tuple, np.ndarray)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, Decimal)):
        return "nan" if value != value else f"{float(value):.6g}"
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None):
        return str(value.replace(tzinfo=None))
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - began
    spark.catalog.clearCache()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"{name}: {len(got)} rows, no SQL, {took:.1f} s", True
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: COLUMNS {sorted(df.columns)} {sorted(names)}", False
    if got != want:
        extra, lacking = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"{name}: DIFFERS {len(got)} {len(want)} rows; extra {extra}; lacking {lacking}", False
    return f"{name}: equal, {len(got)} rows, {took:.1f} s", True


if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    spark = make_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in args or entry.queries():
        try:
            print(compare(spark, con, name, sf_dir)[0], flush=True)
        except Exception as e:
            print(f"{name}: ERROR {str(e)[:1500]}", flush=True)
