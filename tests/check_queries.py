"""Run registered queries against their SQL oracles and report differences.

``python tests/check_queries.py [folder] [query ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def open_oracle(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(records, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(_rows(mine, df.columns), _rows(theirs, names)) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}"
    types = {d[0]: str(d[1]) for d in cur.description}
    pairs = {(t, types[c]) for c, t in df.dtypes}
    known = {
        ("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"),
        ("boolean", "BOOLEAN"),
    }
    return f"types {sorted(pairs - known)}" if pairs - known else None


if __name__ == "__main__":
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = make_session()
    oracle = open_oracle(folder)
    failed = 0
    for query in sys.argv[2:] or entry.oracle_sql():
        start = time.time()
        try:
            problem = compare(session, oracle, folder, query)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{query:30s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    sys.exit(failed > 0)
