"""Run queries in Spark and their SQL in DuckDB over the same files, and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def compare(q, spark, con, sf_dir):
    """None where both sides agree, else what differs first."""
    df = q(spark, sf_dir)
    left = rows_of([tuple(r) for r in df.collect()], df.columns)
    if not q.has_oracle:
        return None if left else "no rows"
    res = con.execute(q.oracle())
    columns = [d[0] for d in res.description]
    right = rows_of(res.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} against {columns}"
    if not left:
        return "no rows"
    if left == right:
        return None
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(left)} rows against {len(right)}, {len(differing)} differ, first {differing[:2]}"


def main(names, sf_dir):
    from checks.all_queries import QUERIES
    from ledgerloom.session import local_session

    spark = local_session()
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(QUERIES[name], spark, con, sf_dir)
        except Exception as e:  # the next query still runs
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(args, folder) else 0)
