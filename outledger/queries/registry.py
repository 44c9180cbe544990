"""Query registry: name, Spark function, and check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outledger.queries.views import SQL_VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and timestamps as text, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        columns.append(col)
    return df.select(*columns)


def with_views(views: str, body: str) -> str:
    """SQL with the named views in front, together with the views those build on."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        uses, _ = SQL_VIEWS[name]
        for other in uses.split():
            add(other)
        needed.append(name)

    for view in views.split():
        add(view)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{n} as ({SQL_VIEWS[n][1].strip()})" for n in needed)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a function (spark, folder) -> DataFrame under ``name``."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: plain(fn(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn

    return register
