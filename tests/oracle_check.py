"""Runs queries against their SQL and compares the rows.

    python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def as_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf: str, name: str, fn, sql: str | None) -> str:
    """Empty when the results agree, else what differs."""
    started = time.time()
    df = fn(spark, sf)
    ours = as_rows(df.columns, df.collect())
    spent = time.time() - started
    print(f"{name:24s} {len(ours):8d} rows {spent:6.1f}s", end=" ", flush=True)
    if sql is None:
        print("no SQL")
        return "" if ours else "no rows"
    started = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = as_rows(names, result.fetchall())
    problem = ""
    if sorted(names) != sorted(df.columns):
        problem = f"columns {sorted(df.columns)} vs {sorted(names)}"
    elif len(ours) != len(theirs):
        problem = f"{len(ours)} rows vs {len(theirs)}"
    elif ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        problem = f"{len(wrong)} rows differ, first {wrong[0]}"
    print(f"sql {time.time() - started:5.1f}s", problem[:1500] or "ok", flush=True)
    return problem


def main(args: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf = args[0] if args else "/root/testdata/sf0.01"
    spark, con = make_session(), connection(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(queries), set(sqls) - set(queries)
    bad = []
    for name, fn in queries.items():
        if args[1:] and name not in args[1:]:
            continue
        try:
            if compare(spark, con, sf, name, fn, sqls.get(name)):
                bad.append(name)
        except Exception as exc:
            print(name, "failed:", str(exc)[:1500])
            bad.append(name)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
