"""Pages, totals and worklists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import PAGE_DEFAULT, PAGE_MAX, PAGE_MIN, PENDING, RECORD_STATUSES
from outledger.operators.aggregates import rollup_columns
from outledger.operators.batching import with_position
from outledger.operators.filters import FilterSpec, apply_filters, conditions
from outledger.session import pin


def clamp(page: int | None, limit: int | None) -> tuple[int, int]:
    """Page from 1, limit within its bounds."""
    return max(1, page or 1), min(PAGE_MAX, max(PAGE_MIN, limit or PAGE_DEFAULT))


def page_of(
    df: DataFrame, order: Sequence, page: int | None = 1, limit: int | None = None
) -> DataFrame:
    """One page of an ordered result, as a top-n: for pages near the start.

    Every task carries all rows up to the page's end; ``far_page`` does not, and ``keyset_page``
    goes on from a known row.
    """
    page, limit = clamp(page, limit)
    return df.orderBy(*order).offset((page - 1) * limit).limit(limit)


def far_page(
    df: DataFrame, order: Sequence[str], page: int | None = 1, limit: int | None = None
) -> DataFrame:
    """One page at any depth, by distributed position: the ordered rows are written once.

    ``order`` names columns that form a unique order.
    """
    page, limit = clamp(page, limit)
    skip = (page - 1) * limit
    rows = with_position(df, list(order))
    wanted = rows.filter((F.col("pos") >= skip) & (F.col("pos") < skip + limit))
    return wanted.orderBy("pos").drop("pos", "total")


def keyset_page(df: DataFrame, key: str, after: object, limit: int) -> DataFrame:
    """The page that follows a known key: a pushed-down range filter and a top-n."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(clamp(1, limit)[1])


def with_total(df: DataFrame, name: str = "total_count") -> DataFrame:
    """The row count beside each row, as a separate aggregate."""
    return df.withColumn(name, df.agg(F.count("*")).scalar())


def page_meta(df: DataFrame, limit: int | None = None, at_least_one: bool = False) -> DataFrame:
    """Total and number of pages, also right when the asked page lies past the end."""
    _, limit = clamp(1, limit)
    pages = F.ceil(F.col("total") / limit)
    return df.agg(F.count("*").alias("total")).select(
        "total", (F.greatest(pages, F.lit(1)) if at_least_one else pages).alias("total_pages")
    )


def overlay_status(
    base: DataFrame, status: DataFrame, key: str, master: str, missing: str = PENDING
) -> DataFrame:
    """Records with their delivery state; records without one are pending."""
    states = status.filter(F.col("master_type") == master).select(
        F.col("record_key").alias("_key"), "push_status", "last_pushed_at", "error_message"
    )
    joined = base.join(states, F.col(key).cast("string") == F.col("_key"), "left")
    return joined.drop("_key").withColumn(
        "push_status", F.coalesce("push_status", F.lit(missing))
    )


def worklist(
    base: DataFrame,
    spec: FilterSpec,
    order: Sequence,
    page: int | None = 1,
    limit: int | None = None,
    statuses: Sequence[str] = RECORD_STATUSES,
    tracked: DataFrame | None = None,
) -> DataFrame:
    """A page of filtered records, each with total, pages and the unfiltered status counts.

    Total and status counts come from one aggregate over the base, as a scalar
    subquery; only the page itself is sorted, as a top-n. ``tracked`` replaces the
    rows whose states are counted where they are not the rows of the list. The base is computed and
    written once; page and figures read the columns they need of it.
    """
    page, limit = clamp(page, limit)
    base = pin(base)
    wanted = reduce(and_, conditions(spec), F.lit(True))
    total = F.count_if(wanted).alias("total")
    rollup = rollup_columns("push_status", statuses)
    if tracked is None:
        figures = base.agg(total, *rollup)
    else:
        figures = base.agg(total, tracked.agg(F.struct(*rollup)).scalar().alias("n")).select(
            "total", "n.*"
        )
    names = [f"n_{s.lower()}" for s in statuses]
    packed = figures.select(F.struct("total", *names)).scalar()
    shown = page_of(apply_filters(base, spec), order, page, limit)
    return (
        shown.withColumn("_f", packed)
        .withColumn("total_count", F.col("_f.total"))
        .withColumn("total_pages", F.ceil(F.col("total_count") / limit))
        .select("*", *[F.col(f"_f.{n}").alias(n) for n in names])
        .drop("_f")
    )
