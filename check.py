"""Compare the bound queries with their SQL: ``python check.py [sf_dir] [name prefix ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from tierweave.bindings import TABLES
from tierweave.checks import ORACLES, QUERIES
from tierweave.session import local_session


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data), sorted(columns)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            got, cols = rows(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name} {len(got)} {took:.1f}s", flush=True)
                continue
            cur = con.execute(ORACLES[name])
            want, wcols = rows([d[0] for d in cur.description], cur.fetchall())
            if cols != wcols:
                raise AssertionError(f"columns {cols} != {wcols}")
            if got != want:
                a, b = set(got) - set(want), set(want) - set(got)
                raise AssertionError(f"rows {len(got)} vs {len(want)}; only spark {sorted(a)[:2]}; only sql {sorted(b)[:2]}")
            print(f"ok    {name} {len(got)} {took:.1f}s", flush=True)
        except Exception as e:  # report and go on
            bad += 1
            print(f"BAD   {name} {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
