"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(
    df: DataFrame, key: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """First row per key in a given, complete order.

    Spark turns the ``= 1`` filter into a WindowGroupLimit: each map task passes
    on at most one row per key, so a hot key does not reach a single task whole.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def union_sources(sources: Sequence[DataFrame], priority: str = "source_priority") -> DataFrame:
    """Sources one below the other, with their rank as a column."""
    frames = [df.withColumn(priority, F.lit(i)) for i, df in enumerate(sources, 1)]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def prefer(
    sources: Sequence[DataFrame], key: Sequence[str], tiebreak: Sequence[str | Column]
) -> DataFrame:
    """The row of the best source per key; ties inside a source need a full tie-break."""
    merged = union_sources(sources)
    return first_by(merged, key, ["source_priority", *tiebreak])


def extreme_per_day(
    punches: DataFrame,
    person: str = "employee_id",
    kind: str = "punch_type",
    time: str = "punch_time",
    ref: str = "ref_id",
    day: Column | None = None,
    first_kind: str = "I",
) -> DataFrame:
    """Earliest punch of the check-in kind, latest of the others, per person, kind and day."""
    stamp = F.struct(F.col(time), F.col(ref))
    when = F.to_date(F.col(time)) if day is None else day
    grouped = punches.groupBy(person, kind, when.alias("punch_day")).agg(
        F.min(stamp).alias("_low"), F.max(stamp).alias("_high")
    )
    chosen = F.when(F.col(kind) == first_kind, F.col("_low")).otherwise(F.col("_high"))
    return grouped.withColumn("_hit", chosen).select(
        person, kind, "punch_day", F.col(f"_hit.{time}"), F.col(f"_hit.{ref}")
    )
