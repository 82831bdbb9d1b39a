"""Run a registered query and its SQL on the same tables and list what differs."""

from collections import Counter
from pathlib import Path

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(row) for row in df.select(*columns).collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], rows


def differences(spark, connection, query, sql: str, folder: str) -> str | None:
    """None if columns and all rows agree (order aside, types as Python sees them), else a short account."""
    columns, found = spark_rows(query(spark, folder))
    wanted_columns, wanted = oracle_rows(connection, sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if found != wanted:
        return (
            f"{found.total()} rows, expected {wanted.total()}; only in Spark: {list((found - wanted).items())[:3]}; "
            f"only in SQL: {list((wanted - found).items())[:3]}"
        )
    kinds = [{type(value) for row in rows for value in (row[i],) if value is not None}
             for rows in (found, wanted) for i in range(len(columns))]
    half = len(columns)
    wrong = [columns[i] for i in range(half) if kinds[i] != kinds[half + i]]
    return f"types differ in {wrong}" if wrong else None
