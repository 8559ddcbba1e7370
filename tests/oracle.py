"""Runs registered queries beside their SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _normal(columns, rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def spark_rows(df):
    return _normal(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    return _normal([d[0] for d in result.description], result.fetchall())


def differences(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference: {str(a)[:300]} != {str(b)[:300]}"
    return None


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from rookery.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    sf_dir = f"{TESTDATA}/sf{sf}"
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            problem = differences(got, duck_rows(con, oracles[name])) if name in oracles else None
            kind = "sql" if name in oracles else "rows"
            print(f"{'BAD' if problem else 'ok ':4}{name:32}{kind:5}{len(got[1]):8} rows {took:6.2f}s", problem or "", flush=True)
            bad += problem is not None
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERR {name:32}", str(error)[:600], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.001", sys.argv[2:]))
