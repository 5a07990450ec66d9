"""Run queries next to their SQL checks on DuckDB and compare the rows.

python -m tests.compare [sf folder] [name part ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def compare(spark, con, folder, plan, sql):
    """None when both sides agree, else a short text."""
    df = plan(spark, folder)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only: {len(got)}"
    # The check has to be one that can be stored as a view.
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")
    cur = con.execute("SELECT * FROM checked")
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}"
    types = {type(v) for r in want for v in r}
    if types & {datetime.date, decimal.Decimal}:
        return f"check returns types {types}"
    if not want:
        return "check gives no rows"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        missing = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows != {len(want)} rows; only spark {extra}; only check {missing}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from tallyloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark, con, sql = local_session(8), connect(folder), e.oracle_sql()
    bad = 0
    for name, plan in e.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            result = compare(spark, con, folder, plan, sql.get(name))
        except Exception as exc:  # noqa: BLE001
            result = "ERROR " + str(exc)[:1500]
        bad += result is not None and not result.startswith("rows only")
        print(f"{'ok ' if result is None else '-- '}{name} {time.time() - t:.2f}s {result or ''}", flush=True)
    print("failed:", bad)
