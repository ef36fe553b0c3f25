"""Run named queries beside their SQL and compare the rows.

    python -m tests.compare [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import glob
import math
import os
import sys
import time

import duckdb
import pyarrow as pa

import __spark_entry__ as entry_file


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        return float(value) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return str(value)


def rows(table: pa.Table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(([tuple(cell(v) for v in r) for r in zip(*columns)]), key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b
    return a == b and type(a) is type(b)


def difference(spark, name: str, sf_dir: str, connection=None) -> tuple[str | None, int, float]:
    """None or what differs, the number of rows, and the seconds Spark took."""
    connection = connection or duck(sf_dir)
    began = time.time()
    mine = entry_file.queries()[name](spark, sf_dir).toArrow()
    took = time.time() - began
    sql = entry_file.oracle_sql().get(name)
    if sql is None:
        return None, mine.num_rows, took
    names, got = rows(mine)
    wanted_names, wanted = rows(connection.sql(sql).arrow().read_all())
    if names != wanted_names:
        return f"columns {names} against {wanted_names}", mine.num_rows, took
    if len(got) != len(wanted):
        return f"{len(got)} rows against {len(wanted)}", mine.num_rows, took
    for a, b in zip(got, wanted):
        if not all(map(close, a, b)):
            return f"row {a} against {b} of {names}", mine.num_rows, took
    return None, mine.num_rows, took


def main() -> int:
    from quillsieve.session import drop_materialised, local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = local_session()
    connection, failed = duck(args.dir), 0
    for name in args.names or sorted(entry_file.queries()):
        try:
            problem, count, took = difference(spark, name, args.dir, connection)
        except Exception as error:
            problem, count, took = f"{type(error).__name__}: {str(error)[:900]}", 0, 0.0
        failed += problem is not None
        checked = "" if name in entry_file.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{checked}: {count} rows, {took:.2f} s{'' if problem is None else ' -- ' + problem}", flush=True)
    drop_materialised(spark)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
