"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.functions.dates import moment
from outledger.functions.text import contains_any


def exclude_values(
    df: DataFrame, column: str, values: Sequence[object], trimmed: bool = False
) -> DataFrame:
    """NOT IN: rows with a listed value go, and so do rows without a value.

    ``trimmed`` compares texts without trailing blanks, on both sides.
    """
    return df.filter(~_listed(df, column, values, trimmed))


def include_values(
    df: DataFrame, column: str, values: Sequence[object], trimmed: bool = False
) -> DataFrame:
    """IN; ``trimmed`` as above."""
    return df.filter(_listed(df, column, values, trimmed))


def _listed(df: DataFrame, column: str, values: Sequence[object], trimmed: bool) -> Column:
    if not trimmed:
        return F.col(column).isin(*values)
    return F.rtrim(F.col(column)).isin(*[str(v).rstrip(" ") for v in values])


def not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither null nor blank."""
    return df.filter(F.rtrim(F.col(column)) != "")


def valid_at(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    """Rows whose validity window holds the as-of time, both ends included."""
    return df.filter((F.col(start) <= as_of) & (F.col(end) >= as_of))


def contained(df: DataFrame, start: str, end: str, low: Column, high: Column) -> DataFrame:
    """Rows whose validity window lies inside a fixed window."""
    return df.filter((F.col(start) >= low) & (F.col(end) <= high))


def search(df: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """Case-insensitive literal substring search over several columns."""
    return df.filter(contains_any([F.col(c) for c in columns], text))


def date_between(
    df: DataFrame, ts: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Inclusive range of days, written on the raw timestamp so that it is pushed down."""
    if first is not None:
        df = df.filter(F.col(ts) >= day_start(first))
    if last is not None:
        df = df.filter(F.col(ts) < day_end(last))
    return df


def day_start(day: str) -> Column:
    """First instant of a day."""
    return moment(f"{day} 00:00:00")


def day_end(day: str) -> Column:
    """First instant after a day."""
    return day_start(day) + F.expr("interval 1 day")


def above(df: DataFrame, column: str, floor: int, cast: str | None = None) -> DataFrame:
    """Rows above a floor, optionally compared after a truncating cast."""
    value = F.col(column) if cast is None else F.col(column).cast(cast)
    return df.filter(value > floor)


def nonzero(df: DataFrame, column: str) -> DataFrame:
    """Rows with an amount other than zero."""
    return df.filter(F.col(column) != 0)


def missing_reason(required: Sequence[str]) -> Column:
    """Name of the first mandatory field that is null or '', null when none is."""
    return F.coalesce(
        *[
            F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(c))
            for c in required
        ]
    )


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all mandatory fields, and the rejected rows with a reason."""
    reason = missing_reason(required)
    return df.filter(reason.isNull()), df.withColumn("reason", reason).filter(reason.isNotNull())


@dataclass(frozen=True)
class FilterSpec:
    """Optional worklist filters; an unset field adds no predicate.

    ``columns`` names the column behind status, division, group, kind and date;
    ``search_in`` the columns a search text is looked up in. ``divisions`` maps a
    division to the LIKE pattern of its brands.
    """

    search: str | None = None
    status: str | None = None
    division: str | None = None
    group: str | None = None
    kind: str | None = None
    date_from: str | None = None
    date_to: str | None = None
    search_in: tuple[str, ...] = ()
    columns: Mapping[str, str] = field(default_factory=dict)
    divisions: Mapping[str, str] | None = None


def conditions(spec: FilterSpec) -> list[Column]:
    """The predicates of the filters that are set."""
    found = []
    if spec.search:
        found.append(contains_any([F.col(c) for c in spec.search_in], spec.search))
    if spec.division and spec.divisions is not None:
        pattern = spec.divisions.get(spec.division)
        brand = F.col(spec.columns["division"])
        found.append(brand.like(pattern) if pattern else F.lit(False))
    elif spec.division:
        found.append(F.col(spec.columns["division"]) == spec.division)
    for name in ("status", "group", "kind"):
        wanted = getattr(spec, name)
        if wanted:
            found.append(F.col(spec.columns[name]) == wanted)
    if spec.date_from:
        found.append(F.col(spec.columns["date"]) >= day_start(spec.date_from))
    if spec.date_to:
        found.append(F.col(spec.columns["date"]) < day_end(spec.date_to))
    return found


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Only the filters that are set, so Catalyst can prune and push each of them."""
    for condition in conditions(spec):
        df = df.filter(condition)
    return df
