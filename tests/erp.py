"""Hand-written ERP tables: only the columns a case needs, the rest is null."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

from outledger.sources.schemas import ERP


def table(spark, role_or_schema, *rows):
    """A DataFrame of a declared role (or schema text) from partial rows."""
    ddl = ERP.get(role_or_schema, role_or_schema)
    schema = spark.createDataFrame([], ddl).schema

    def fit(field, value):
        if value is None:
            return None
        if isinstance(field.dataType, T.DecimalType):
            return Decimal(str(value))
        if isinstance(field.dataType, T.TimestampNTZType):
            return datetime.fromisoformat(value)
        return value

    data = [tuple(fit(f, row.get(f.name)) for f in schema.fields) for row in rows]
    return spark.createDataFrame(data, schema)


def tables(spark, **roles):
    """All ERP roles; those not given are empty."""
    return {role: table(spark, role, *roles.get(role, [])) for role in ERP}


def by(df, *keys):
    """Collected rows as plain dicts, by key."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
