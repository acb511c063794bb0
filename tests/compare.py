"""Run registered queries and their SQL side by side; ``python tests/compare.py [folder] [names...]``."""

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


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, folder: str, name: str, build, statement: str) -> list[str]:
    result = build(spark, folder)
    ours = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    cursor = con.execute(statement)
    theirs = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} / {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows {len(ours[1])} / {len(theirs[1])}", str(ours[1][:2]), str(theirs[1][:2])]
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return [f"{len(bad)} of {len(ours[1])} rows differ", *map(str, bad[:2])] if bad else []


def main() -> None:
    import __spark_entry__ as entry
    from shelfmark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(folder), entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    print("no SQL:", sorted(set(queries) - set(oracle)), "no query:", sorted(set(oracle) - set(queries)))
    failed = 0
    for name in wanted:
        began = time.time()
        try:
            found = differences(spark, con, folder, name, queries[name], oracle[name]) if name in oracle else []
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.2f}s", *found, sep="\n     " if found else " ")
    print(f"{failed} of {len(wanted)} failed")


if __name__ == "__main__":
    main()
