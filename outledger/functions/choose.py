"""Choosing a value: defaults, classes, lookups by code or by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(col: Column, yes: str = "Y") -> Column:
    """1 when ``col`` equals the yes-code, else 0 (also for null)."""
    return F.when(col == yes, 1).otherwise(0)


def flag_bool(col: Column, yes: str = "Y") -> Column:
    """True when ``col`` equals the yes-code, else False (also for null)."""
    return F.coalesce(col == yes, F.lit(False))


def case(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First value whose condition holds, else ``default``."""
    chosen = reduce(
        lambda acc, rule: acc.when(rule[0], rule[1]), rules[1:], F.when(rules[0][0], rules[0][1])
    )
    return chosen.otherwise(F.lit(default))


def classify_like(
    col: Column, rules: Sequence[tuple[str, str]], default: str | None = None
) -> Column:
    """Class of the first LIKE pattern that matches; null input takes the default."""
    return case([(col.like(pattern), F.lit(value)) for pattern, value in rules], default)


def lookup(col: Column, table: Mapping[str, object]) -> Column:
    """Value of a small constant table, null when the code is not in it."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), col)


def code_to_name(code: Column, names: Mapping[str, str]) -> Column:
    """Name of a trimmed, case-insensitive code; unknown codes stay, blank is null."""
    known = lookup(F.upper(F.trim(code)), names)
    return F.when(code != "", F.coalesce(known, code))


def pick(condition: Column, yes: Column, no: Column) -> Column:
    """``yes`` where the condition holds, ``no`` elsewhere (also when it is unknown)."""
    return F.when(condition, yes).otherwise(no)


def null_default(*cols: Column) -> Column:
    """First non-null value."""
    return F.coalesce(*cols)


def falsy_default(col: Column, default: object, empty: object = 0) -> Column:
    """Default for null and for the empty value (0 for numbers, '' for text)."""
    return F.coalesce(F.nullif(col, F.lit(empty)), F.lit(default))


def blank_chain(*cols: Column) -> Column:
    """First column that is neither null nor blank; the last one is taken as it is."""
    *heads, last = cols
    return F.coalesce(*[F.nullif(F.rtrim(c), F.lit("")) for c in heads], last)


def by_column_name(name: Column, columns: Mapping[str, Column], default: object = 0) -> Column:
    """Value of the column whose name is data; null values and unknown names give the default."""
    return F.coalesce(*[F.when(name == n, c) for n, c in columns.items()], F.lit(default))


def stock_labels(
    minimum: Column,
    on_hand: Column,
    below: tuple[str, str] = ("High Stock", "Very few stock left"),
    enough: tuple[str, str] = ("Low Stock", "Stock Available"),
) -> tuple[Column, Column]:
    """Two stock texts: one on raw quantities, one on whole units."""
    raw = F.when(minimum > on_hand, below[0]).otherwise(enough[0])
    whole = F.when(minimum.cast("int") > on_hand.cast("int"), below[1]).otherwise(enough[1])
    return raw, whole
