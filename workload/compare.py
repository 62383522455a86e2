"""Run the registered queries and compare them with their SQL counterparts.

    python -m workload.compare [folder of tables] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value + 0.0, 6))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf, key, query, sql):
    """None if both agree, else what differs."""
    frame = query(spark, sf)
    ours = _rows(frame.columns, frame.collect())
    if sql is None:
        return "no SQL to compare with"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(different)} of {len(ours)} rows, first {different[0]}" if different else None


def connect(sf):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')"
        )
    return connection


def main() -> int:
    from tidewatch.session import build_session
    from workload import oracle
    from workload.queries import REGISTERED

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(REGISTERED)
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls = connect(sf), oracle.statements()
    failed = 0
    for key in wanted:
        start = time.time()
        try:
            problem = compare(spark, connection, sf, key, REGISTERED[key], sqls.get(key))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{key:32} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
