"""Running a registered query and its check SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    """In-process DuckDB with the test tables as views."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain_type(arrow_type) -> str:
    name = str(arrow_type).replace("large_", "")
    return "null_or_string" if name in ("null", "string") else name


def plain_value(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    return str(value)


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    return sorted(tuple(plain_value(r[n]) for n in names) for r in table.to_pylist())


def difference(spark_df, con, sql: str) -> str:
    """Empty when both sides agree on columns, types and rows."""
    left, right = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(left.column_names) != sorted(right.column_names):
        return f"columns {sorted(left.column_names)} != {sorted(right.column_names)}"
    for name in left.column_names:
        a = plain_type(left.schema.field(name).type)
        b = plain_type(right.schema.field(name).type)
        if a != b:
            return f"type of {name}: {a} != {b}"
    a, b = rows_of(left), rows_of(right)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if not a:
        return "no rows"
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"values differ, spark {only_a} check {only_b}"
    return ""
