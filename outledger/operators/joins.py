"""Joins.

No join here carries a broadcast hint: Spark broadcasts a side when its known
or measured size allows it, and otherwise shuffles, with AQE splitting hot keys.
Relations of a fixed, literal size are exploded into rows instead of joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.operators import blocks


def _keys(sub: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of a tested side. Duplicates fold on the map side, so a key that
    fills the tested table reaches its task as a few rows instead of all of them."""
    return sub.select(*([on] if isinstance(on, str) else on)).distinct()


def inner(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join."""
    return left.join(right, on, "inner")


def left(
    outer: DataFrame,
    detail: DataFrame,
    on: str | Sequence[str],
    only: Column | None = None,
) -> DataFrame:
    """Left join to optional detail; ``only`` is an ON-clause filter of the detail side."""
    return outer.join(detail if only is None else detail.filter(only), on, "left")


def with_dimension(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Every row once per entry of a constant dimension, without a join."""
    entries = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows])
    return df.withColumn("_dim", F.explode(entries)).select(
        *df.columns, *[F.col(f"_dim.{k}").alias(k) for k in rows[0]]
    )


def where_exists(df: DataFrame, sub: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows with at least one match."""
    return df.join(_keys(sub, on), on, "left_semi")


def where_exists_any(
    df: DataFrame, branches: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """EXISTS (a) OR EXISTS (b) OR ...: rows never multiply.

    Each branch is a left join to its distinct keys. Unlike an existence join, a
    left join can be split by AQE where the keys of ``df`` are skewed.
    """
    tested = df
    for i, (sub, on) in enumerate(branches):
        hit = _keys(sub, on).withColumn(f"_hit{i}", F.lit(True))
        tested = tested.join(hit, list(on), "left")
    hits = F.coalesce(*[F.col(f"_hit{i}") for i in range(len(branches))])
    return tested.filter(hits).select(*df.columns)


def where_in(df: DataFrame, column: str, sub: DataFrame, sub_column: str) -> DataFrame:
    """column IN (SELECT sub_column ...)."""
    return where_exists(df, sub.select(F.col(sub_column).alias(column)), column)


def where_listed(df: DataFrame, column: str, sub: DataFrame) -> DataFrame:
    """``where_exists`` on one column, tested on the rows that ``df`` is made from.

    Spark moves an IN filter below joins and groupings that keep ``column``, which it does not do
    with a semi-join: rows without a match are gone before those shuffle.
    """
    text = f"select * from {{df}} where `{column}` in (select `{column}` from {{keys}})"
    return df.sparkSession.sql(text, df=df, keys=_keys(sub, column))


def anti(new: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows without a match: the insert half of insert-if-absent."""
    return new.join(_keys(existing, key), key, "left_anti")


def latest_per_key(
    outer: DataFrame,
    detail: DataFrame,
    on: Sequence[str],
    order: Sequence[str],
    take: Sequence[str],
) -> DataFrame:
    """Detail columns of the highest order value per key, null where there is none.

    The detail side is reduced before the join, so a hot key leaves each map
    task as one row.
    """
    best = detail.groupBy(*on).agg(
        F.max_by(F.struct(*take), F.struct(*order)).alias("_best")
    )
    return outer.join(best, list(on), "left").select(
        *outer.columns, *[F.col(f"_best.{c}").alias(c) for c in take]
    )


def first_per_key(
    outer: DataFrame,
    detail: DataFrame,
    on: Sequence[str],
    order: Sequence[str],
    take: Sequence[str],
) -> DataFrame:
    """As ``latest_per_key``, for the lowest order value."""
    best = detail.groupBy(*on).agg(
        F.min_by(F.struct(*take), F.struct(*order)).alias("_best")
    )
    return outer.join(best, list(on), "left").select(
        *outer.columns, *[F.col(f"_best.{c}").alias(c) for c in take]
    )


def join_on_concat(
    left_df: DataFrame, right: DataFrame, left_cols: Sequence[str], right_cols: Sequence[str]
) -> DataFrame:
    """Join on the un-delimited concatenation of several columns, null as ''.

    Keys can collide ('A'+'BC' and 'AB'+'C'); ``inner`` on the single columns is
    the safe form.

    Rows of a key multiply, so ``blocks`` forms them, and all columns given are stored for it: leave
    out what is not wanted. ``left_df`` is the side with fewer rows per key.
    """
    return blocks.pairs(left_df, right, left_cols, right_cols)


def key_text(col: Column) -> Column:
    """A number as the text it is stored as elsewhere, for use in an equi-condition."""
    return col.cast("string")


def key_trimmed(col: Column) -> Column:
    """Text key without trailing blanks."""
    return F.rtrim(col)


def keys_minus(requested: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Distinct requested keys that are not among the failed ones."""
    return anti(requested.select(key).distinct(), failed, key)
