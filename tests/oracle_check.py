"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.environ.get("TESTDATA_DIR", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a short text; and the number of rows."""
    frame = query(spark, sf_dir)
    got_columns, got = _table(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    want_columns, want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", sum(got.values())
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return (
            f"{sum(got.values())} rows against {sum(want.values())}\n  only spark: {extra}"
            f"\n  only sql:   {missing}"
        ), sum(got.values())
    return None, sum(got.values())


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from docfold.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"{ROOT}/sf{sf}"
    names = sys.argv[2:] or list(contract.queries())
    spark, con, failed = local_session(), connect(sf_dir), 0
    oracle = contract.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problem, rows = compare(spark, con, contract.queries()[name], oracle[name], sf_dir)
            else:
                problem, rows = None, contract.queries()[name](spark, sf_dir).count()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += problem is not None
        mark = "FAIL" if problem else ("ok" if name in oracle else "rows only")
        print(f"{name}: {mark} {rows} rows {time.time() - start:.1f}s {problem or ''}", flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
