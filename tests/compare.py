"""Side-by-side run of the registered queries and their SQL, also usable as a script."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return repr([normal(v) for v in value])
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from tickwell.session import local_session

    spark = local_session()
    for setting in filter(None, os.environ.get("COMPARE_CONF", "").split(",")):
        spark.conf.set(*setting.split("="))
    con = connect(folder)
    bad = 0
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            columns, got = spark_rows(fn(spark, folder))
        except Exception as problem:  # noqa: BLE001
            print("FAIL", name, str(problem)[:1500])
            bad += 1
            continue
        took = time.time() - started
        if name not in e.oracle_sql():
            print(f"rows {name} {len(got)} {took:.2f}s")
            continue
        try:
            want_columns, want = sql_rows(con, e.oracle_sql()[name])
        except Exception as problem:  # noqa: BLE001
            print("SQLFAIL", name, str(problem)[:800])
            bad += 1
            continue
        if columns != want_columns or got != want:
            bad += 1
            print("DIFF", name, len(got), len(want), columns == want_columns or (columns, want_columns))
            only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
            print("   spark", len(only_got), only_got[:2])
            print("   sql  ", len(only_want), only_want[:2])
        else:
            print(f"ok   {name} {len(got)} {took:.2f}s")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    sys.exit(main(sys.argv[1], sys.argv[2:]))
