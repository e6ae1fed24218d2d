"""Spark results against DuckDB results, without regard to row or column order."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


# Spark and DuckDB type names that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, connection, sql: str) -> list[str]:
    """What differs; empty if the results are equal."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} and {sorted(names)}"]
    for name, spark_type in spark_df.dtypes:
        if SAME_TYPE.get(spark_type) != types[name]:
            found.append(f"type of {name}: {spark_type} and {types[name]}")
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if actual != expected:
        found.append(
            f"{sum(actual.values())} rows and {sum(expected.values())} rows; "
            f"only Spark: {list((actual - expected).items())[:3]}; only SQL: {list((expected - actual).items())[:3]}"
        )
    return found
