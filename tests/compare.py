"""Runs registered queries next to their SQL and compares the rows.

    python tests/compare.py [sf dir] [name part ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def _value(v):
    return repr(v) if isinstance(v, float) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir, query, sql):
    """None if both give the same columns and rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        less, more = list((want - got).items())[:3], list((got - want).items())[:3]
        return (
            f"{sum(got.values())} rows against {sum(want.values())} ({sorted(names)}): "
            f"missing {less}, added {more}"
        )
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from siftline.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con = local_session("8"), connection(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in sqls:
                diff = difference(spark, con, sf, query, sqls[name])
                n = "" if diff else con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0]
            else:
                diff, n = None, query(spark, sf).count()
        except Exception as e:
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} rows={n} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print("failures:", bad, "queries without SQL:", sorted(set(queries) - set(sqls)),
          "SQL without query:", sorted(set(sqls) - set(queries)))
