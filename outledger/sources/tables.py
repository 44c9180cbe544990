"""Scans of business tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.operators.joins import where_exists


def scan(spark: SparkSession, folder: str, name: str, schemas: Mapping[str, str]) -> DataFrame:
    """A named Parquet table with its declared schema."""
    return spark.read.schema(schemas[name]).parquet(f"{folder}/{name}.parquet")


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    bounds: tuple[int, int],
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A live table, read in ranges of a numeric column by many tasks at once."""
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, table, split_on, bounds, partitions), **(options or {}))
        .load()
    )


def jdbc_options(
    url: str, table: str, split_on: str, bounds: tuple[int, int], partitions: int
) -> dict[str, str]:
    """Options of a ranged JDBC read."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": split_on,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        "pushDownPredicate": "true",
    }


def inline_lookup(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant relation."""
    return spark.createDataFrame(list(rows), schema)


def by_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Full rows of the wanted keys; no keys, no rows."""
    return where_exists(df, keys, on)


def by_id(df: DataFrame, column: str, value: object) -> DataFrame:
    """The row of one primary key, or none; the predicate reaches the Parquet statistics."""
    return df.filter(F.col(column) == F.lit(value))


def day_slice(df: DataFrame, ts: str, day: str, kind: Column | None = None) -> DataFrame:
    """Rows of one calendar day, as a half-open range so that row groups are skipped."""
    start = moment(f"{day} 00:00:00")
    rows = df.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day")))
    return rows if kind is None else rows.filter(kind)


def extract(
    df: DataFrame, condition: Column, columns: Mapping[str, Column | str]
) -> DataFrame:
    """Rows of a group as a projection that may contain constants."""
    return df.filter(condition).select(
        *[(c if isinstance(c, Column) else F.lit(c)).alias(n) for n, c in columns.items()]
    )


def distinct_values(df: DataFrame, column: str, condition: Column | None = None) -> DataFrame:
    """Sorted distinct trimmed non-blank values."""
    rows = df if condition is None else df.filter(condition)
    values = rows.select(F.rtrim(F.col(column)).alias(column))
    return values.filter(F.col(column) != "").distinct().orderBy(column)


def suggest(values: DataFrame, column: str, text: str) -> DataFrame:
    """Values that contain the typed text, whatever the case; blank text keeps all."""
    needle = text.strip().lower()
    return values.filter(F.lower(F.col(column)).contains(needle)) if needle else values


def extract_all(df: DataFrame, *keys: str) -> DataFrame:
    """The whole extract in key order: one partitioned scan, no page loop."""
    return df.orderBy(*keys)
