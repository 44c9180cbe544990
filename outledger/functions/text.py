"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from outledger.fixed_values import ERROR_TEXT_LIMIT, NO_PHONE


def concat_blank(*cols: Column) -> Column:
    """Concatenation that reads null as ''."""
    return F.concat_ws("", *[c.cast("string") for c in cols])


def concat_null(*cols: Column) -> Column:
    """Concatenation that is null as soon as one part is null."""
    return F.concat(*[c.cast("string") for c in cols])


def is_digits(col: Column) -> Column:
    """Only decimal digits, at least one."""
    return F.coalesce(col.rlike("^[0-9]+$"), F.lit(False))


def clean_grade(
    col: Column, word: str = "Grade", default: str = "C", blanks: Sequence[str] = ("", "-")
) -> Column:
    """Default for null, blank or '-', else the text without ``word``."""
    blank = F.rtrim(F.coalesce(col, F.lit(""))).isin(*blanks)
    return F.when(blank, default).otherwise(F.replace(col, F.lit(word), F.lit("")))


def first_phone(*cols: Column, default: str = NO_PHONE) -> Column:
    """Last ten characters of the first column where they are ten digits."""
    tails = [F.right(F.rtrim(c), F.lit(10)) for c in cols]
    return F.coalesce(*[F.when(t.rlike("^[0-9]{10}$"), t) for t in tails], F.lit(default))


def truncate_text(col: Column, limit: int = ERROR_TEXT_LIMIT) -> Column:
    """The first ``limit`` characters; '' counts as no text."""
    return F.nullif(F.substring(col, 1, limit), F.lit(""))


def composite_key(parent: Column, child: Column) -> Column:
    """``parent:child`` with place holders for missing parts."""
    return F.concat_ws(
        ":",
        F.coalesce(parent.cast("string"), F.lit("UNKNOWN")),
        F.coalesce(child.cast("string"), F.lit("NA")),
    )


def parent_of(key: Column) -> Column:
    """The part of a composite key before the first colon."""
    return F.substring_index(key, ":", 1)


def contains_any(cols: Sequence[Column], text: str) -> Column:
    """Case-insensitive literal substring test over several columns."""
    needle = F.lower(F.lit(text))
    hits = [F.lower(c.cast("string")).contains(needle) for c in cols]
    found = hits[0]
    for hit in hits[1:]:
        found = found | hit
    return found
