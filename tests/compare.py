"""Run a registered query and its SQL and compare them row by row."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def kind(value) -> object:
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return (type(value).__name__, str(value))


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(kind(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}


def spark_type(name: str) -> str:
    return SPARK_TYPES.get(name, name.upper())


def difference(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    described = {r[0]: r[1].replace(" ", "") for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {c: (spark_type(t).replace(" ", ""), described[c]) for c, t in df.dtypes}
    odd = {c: pair for c, pair in types.items() if pair[0] != pair[1]}
    if odd:
        return f"types {odd}"
    if actual != expected:
        missing = [r for r in expected if r not in set(actual)][:2]
        extra = [r for r in actual if r not in set(expected)][:2]
        return f"{len(actual)} rows instead of {len(expected)}; missing {missing}; extra {extra}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from basketline.session import local_session

    folder = sys.argv[1]
    only = set(sys.argv[2:])
    spark, con = local_session(8), connect(folder)
    sql = e.oracle_sql()
    bad = 0
    queries = e.queries()
    print("without SQL:", sorted(set(queries) - set(sql)), "without query:", sorted(set(sql) - set(queries)))
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
