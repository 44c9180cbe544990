"""Date expressions. The as-of time is always an argument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(text: str) -> Column:
    """Wall-clock timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def effective_due(
    kind: Column, due: Column, booked: Column, due_kinds: Sequence[str] = ("-2", "30")
) -> Column:
    """Due date for some transaction kinds, booking date for the others."""
    return F.when(kind.isin(*due_kinds), due).otherwise(booked)


def days_overdue(balance: Column, due: Column, as_of: Column) -> Column:
    """Day boundaries between due and as-of while something is owed, else 0."""
    return F.when(balance > 0, F.datediff(as_of, due)).otherwise(0)


def date_text(col: Column) -> Column:
    """``2024-01-31``; text that is no timestamp gives null."""
    return F.date_format(col.try_cast("timestamp"), "yyyy-MM-dd")


def iso_text(col: Column) -> Column:
    """``2024-01-31T08:05:00``."""
    return F.date_format(col.try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")


def millis_text(col: Column) -> Column:
    """``2024-01-31 08:05:00.250``."""
    return F.date_format(col.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")


def local_day(ts: Column, timezone: str | None = None) -> Column:
    """Day of a UTC timestamp, in a business time zone when one is given."""
    return F.to_date(ts if timezone is None else F.from_utc_timestamp(ts, timezone))
