"""Run every query and its SQL on one folder of tables and compare all rows.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import all_oracles
from checks.queries import all_queries
from corpusloom.session import get_session


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """'' where columns and rows agree, else what does not."""
    found = all_queries()[name](spark, folder)
    columns = sorted(found.columns)
    wanted = connection.execute(all_oracles()[name])
    wanted_columns = [c[0] for c in wanted.description]
    if columns != sorted(wanted_columns):
        return f"columns {columns} and {sorted(wanted_columns)}"
    types = {c[0]: str(c[1]) for c in wanted.description}
    for column, kind in found.dtypes:
        if TYPES[kind] != types[column]:
            return f"{column} is {kind} and {types[column]}"
    places = [wanted_columns.index(c) for c in columns]
    expected = Counter(tuple(_plain(row[p]) for p in places) for row in wanted.fetchall())
    got = Counter(tuple(_plain(v) for v in row) for row in found.select(columns).collect())
    if got == expected:
        return ""
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows and {sum(expected.values())}; only here "
        f"{list(extra)[:2]!r:.300}, only there {list(missing)[:2]!r:.300}"
    )


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark = get_session(
        "checks",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        begin = time.perf_counter()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # one broken query should not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:26} {time.perf_counter() - begin:6.1f}s  {problem or 'equal'}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
