"""Compare registered queries with their SQL in DuckDB: python -m tests.oracle [sf] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
    return a == b


def compare(frame, con, sql: str) -> str:
    """``ok``, or what differs. Values must be identical after sorting rows and columns."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = table(names, cursor.fetchall())
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])} rows"
    if not got[1]:
        return "no rows"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    if not bad:
        return "ok"
    near = all(len(g) == len(w) and all(close(x, y) for x, y in zip(g, w)) for g, w in bad)
    return f"{len(bad)} of {len(got[1])} rows differ{' (only by float noise)' if near else ''}: {bad[0]}"


def main() -> int:
    from crewcast.catalog import ORACLES, QUERIES
    from crewcast.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        begin = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                result = compare(frame, con, ORACLES[name])
            else:
                result = f"ok (rows only: {frame.count()})"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not result.startswith("ok")
        print(f"{name:28s} {time.time() - begin:6.2f}s  {result}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
