"""Aggregations. All of them combine on the map side, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import PUNCH_STATUSES, RECORD_STATUSES


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    """Number of rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def price_summary(df: DataFrame, keys: Sequence[str], state: str, price: str) -> DataFrame:
    """Entries, distinct states and the price range per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("price_entries"),
        F.count_distinct(state).alias("state_count"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def sum_whole(df: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """Exact sum per key, then cut to whole units."""
    return df.groupBy(*keys).agg(F.sum(amount).cast("bigint").alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct projected rows."""
    return df.distinct()


def group_dedupe(df: DataFrame, *keys: str) -> DataFrame:
    """GROUP BY without aggregates."""
    return df.select(*keys).distinct()


def status_rollup(
    df: DataFrame, column: str = "push_status", statuses: Sequence[str] = RECORD_STATUSES
) -> DataFrame:
    """Count per status: listed ones always present, others kept as they occur."""
    listed = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in statuses])).alias(column),
        F.lit(0).cast("bigint").alias("n"),
    )
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.unionByName(listed).groupBy(column).agg(F.sum("n").alias("n"))


def rollup_columns(column: str = "push_status", statuses: Sequence[str] = RECORD_STATUSES):
    """The same counts as columns of one aggregate row."""
    return [F.count_if(F.col(column) == s).alias(f"n_{s.lower()}") for s in statuses]


def pivot_rollup(
    df: DataFrame, group: Column, status: str, statuses: Sequence[str] = PUNCH_STATUSES
) -> DataFrame:
    """Listed status counts per group, and a total that also counts unlisted statuses."""
    return df.groupBy(group).agg(
        *rollup_columns(status, statuses), F.count("*").alias("total")
    )


def delivery_counts(batches: DataFrame, keys: Sequence[str], ok: str, size: str) -> DataFrame:
    """Batches and records by outcome."""
    good, bad = F.col(ok), ~F.col(ok)
    return batches.groupBy(*keys).agg(
        F.count("*").alias("total_batches"),
        F.sum(size).cast("bigint").alias("total_records"),
        F.count_if(good).alias("success_batches"),
        F.count_if(bad).alias("failed_batches"),
        F.coalesce(F.sum(F.when(good, F.col(size))), F.lit(0)).cast("bigint").alias(
            "success_records"
        ),
        F.coalesce(F.sum(F.when(bad, F.col(size))), F.lit(0)).cast("bigint").alias(
            "failed_records"
        ),
    )


def unify_counts(df: DataFrame, total: Sequence[str], ok: Sequence[str], bad: Sequence[str]):
    """Total, success and failed from result shapes that name them differently."""
    return df.select(
        "*",
        F.coalesce(*[F.col(c) for c in total]).alias("total_count"),
        F.coalesce(*[F.col(c) for c in ok]).alias("ok_count"),
        F.coalesce(*[F.col(c) for c in bad]).alias("bad_count"),
    )
