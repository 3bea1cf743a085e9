"""Compare a Spark result with DuckDB rows: same columns, same multiset of rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return "0.0" if value == 0 else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, query):
    """None when equal, else a short account of the difference."""
    cursor = connection.execute(query)
    expected_columns = [d[0] for d in cursor.description]
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(expected_columns)}"
    expected = rows_of(expected_columns, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual == expected:
        return None
    extra = [r for r in actual if r not in set(expected)][:2]
    missing = [r for r in expected if r not in set(actual)][:2]
    return f"{len(actual)} vs {len(expected)} rows; only Spark: {extra}; only SQL: {missing}"
