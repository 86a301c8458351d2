"""Run every named query beside its SQL and report differences: ``python tests/check_queries.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(spark, con, folder: str, name: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    df = queries()[name](spark, folder)
    found = sorted_rows(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None if found[1] else "no rows"
    relation = con.sql(sql)
    wanted = sorted_rows(list(relation.columns), relation.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if found[1] != wanted[1]:
        odd = [(a, b) for a, b in zip(found[1], wanted[1]) if a != b][:3]
        return f"{len(found[1])} rows against {len(wanted[1])}: {odd}"
    return None


def main() -> int:
    from tallyframe.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(queries())
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        began = time.monotonic()
        try:
            odd = differences(spark, con, folder, name)
        except Exception as error:
            odd = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in oracle_sql() else "rows"
        print(f"{'ok ' if odd is None else 'BAD'} {kind:4} {name} {time.monotonic() - began:.1f}s {odd or ''}", flush=True)
        bad += odd is not None
    spark.stop()
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
