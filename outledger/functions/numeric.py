"""Number expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from outledger.fixed_values import TAX_REMAP
from outledger.functions.choose import lookup
from outledger.functions.text import is_digits


def digits_to_int(col: Column) -> Column:
    """Digits-only text as a whole number, anything else null."""
    return F.when(is_digits(col), col.try_cast("bigint"))


def trunc_int(col: Column) -> Column:
    """Whole part, cut towards zero."""
    return col.cast("int")


def to_decimal(col: Column, precision: int = 10, scale: int = 2) -> Column:
    """Decimal with half-up rounding."""
    return col.cast(f"decimal({precision},{scale})")


def fixed2(col: Column) -> Column:
    """Text with two decimals; null reads as 0."""
    return F.coalesce(col.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)")).cast("string")


def tax_text(col: Column, remap: Mapping[str, str] = TAX_REMAP) -> Column:
    """Rate as text with two decimals, some rates rewritten; null stays null."""
    text = col.cast("decimal(18,2)").cast("string")
    return F.coalesce(lookup(text, remap), text)


def number_or_null(col: Column) -> Column:
    """Number, or null for null, blank text and text that is no number."""
    value = F.trim(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)
