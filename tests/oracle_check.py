"""Compare registered queries with their SQL statements: ``python tests/oracle_check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "null" if value is None else f"{value}"


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def run_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    con.execute(sql)
    return normal([d[0] for d in con.description], con.fetchall())


def run_spark(df) -> tuple[list[str], list[tuple]]:
    return normal(df.columns, [tuple(r) for r in df.collect()])


def main() -> int:
    import __spark_entry__ as e
    from foliomill.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if args and name not in args:
            continue
        try:
            start = time.time()
            got = run_spark(fn(spark, sf_dir))
            middle = time.time()
            want = run_sql(con, sql[name]) if name in sql else None
            end = time.time()
        except Exception as problem:
            failed += 1
            print(f"ERROR {name}: {str(problem)[:1500]}", flush=True)
            continue
        verdict = "rows " if want is None else "ok   " if got == want else "DIFF "
        failed += verdict == "DIFF "
        print(f"{verdict} {name}: {len(got[1])} rows, spark {middle - start:.2f}s, sql {end - middle:.2f}s", flush=True)
        if verdict == "DIFF ":
            print("   columns", got[0], want[0], len(want[1]))
            for a, b in zip(got[1], want[1]):
                if a != b:
                    print("   spark", str(a)[:400], "\n   sql  ", str(b)[:400])
                    break
    return failed


if __name__ == "__main__":
    sys.exit(main())
