"""Child rows to arrays of structs.

An array lives in one row, so lists come in chunks of at most ``part_rows`` elements: a document is
one or more rows, told apart by ``part_no`` (0-based) of ``parts``. Row k holds the elements k x
part_rows and on of every list, in order; row 0 therefore always exists and holds the head of every
list. That shape is the same at every size. Only parents with more children than a chunk need
ordinals; those come from a range-sorted position, so a hot parent is not one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.operators.batching import with_position
from outledger.session import pin

PART_ROWS = 10_000


@dataclass(frozen=True)
class ChildList:
    """Rows of one list: which columns an element has and how elements are ordered."""

    rows: DataFrame
    fields: Sequence[str]
    order: Sequence[str]


def nest_lists(
    lists: Mapping[str, ChildList],
    key: str,
    part_rows: int | None = PART_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """All lists of a document in chunks; a list without rows in a chunk is null there.

    ``part_rows=None`` states that the children of a parent are bounded by a
    constant (a fixed dimension) and skips the counting pass. ``sizes`` (key, n)
    gives an upper bound of children per parent where that is cheaper to get
    than by counting the lists themselves.
    """
    tall = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            c.rows.select(
                key,
                F.lit(number).alias("_list"),
                F.struct(
                    F.struct(*c.order).alias("o"), F.struct(*c.fields).alias("v")
                ).alias(name),
            )
            for number, (name, c) in enumerate(lists.items())
        ],
    )
    if part_rows is None:
        tall = tall.withColumn("part_no", F.lit(0))
        return _folded(tall, key, lists).withColumn("parts", F.lit(1))
    if sizes is None:
        sizes = tall.groupBy(key).agg(F.count("*").alias("n"))
    large = pin(sizes.filter(F.col("n") > part_rows).select(key))
    if large.isEmpty():  # the usual case: the same rows without the second branch
        return _folded(tall.withColumn("part_no", F.lit(0)), key, lists).withColumn("parts", F.lit(1))
    # Null-safe throughout: the children of a null key are chunked like those of any other.
    is_large = F.col(key).eqNullSafe(F.col("_large"))
    large = large.withColumnRenamed(key, "_large")
    small = tall.join(large, is_large, "left_anti").withColumn("part_no", F.lit(0))
    ranked = with_position(tall.join(large, is_large, "left_semi"), [key, "_list", *lists])
    first = ranked.groupBy(F.col(key).alias("_of"), F.col("_list").alias("_of_list")).agg(
        F.min("pos").alias("_first")
    )
    same = F.col(key).eqNullSafe(F.col("_of")) & (F.col("_list") == F.col("_of_list"))
    ordinal = F.col("pos") - F.col("_first")
    chunked = ranked.join(first, same).withColumn("part_no", F.floor(ordinal / part_rows).cast("int"))
    nested = _folded(small.unionByName(chunked.select(*small.columns)), key, lists)
    parts = chunked.groupBy(F.col(key).alias("_of")).agg((F.max("part_no") + 1).alias("_parts"))
    return (
        nested.join(parts, F.col(key).eqNullSafe(F.col("_of")), "left")
        .withColumn("parts", F.coalesce("_parts", F.lit(1)))
        .drop("_parts", "_of")
    )


def _folded(tall: DataFrame, key: str, lists: Mapping[str, ChildList]) -> DataFrame:
    return tall.groupBy(key, "part_no").agg(*[_ordered(F.col(name)).alias(name) for name in lists])


def ordered_list(order: Sequence[str], fields: Sequence[str]) -> Column:
    """Aggregate: all rows of a group, bounded by a constant, as one ordered list of ``fields``."""
    return _ordered(F.struct(F.struct(*order).alias("o"), F.struct(*fields).alias("v")))


def heads(docs: DataFrame) -> DataFrame:
    """One row per document: its own fields and the head of each of its lists."""
    return docs.filter("part_no = 0")


def places(docs: DataFrame, name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The elements of one list as ``col`` with their place ``pos`` in the whole list."""
    rows = docs.select("*", F.posexplode(name).alias("_at", "col"))
    return rows.withColumn("pos", F.col("part_no") * part_rows + F.col("_at")).drop("_at")


def _ordered(element: Column) -> Column:
    sorted_rows = F.array_sort(F.collect_list(element))
    return none_if_empty(F.transform(sorted_rows, lambda row: row["v"]))


def none_if_empty(col: Column) -> Column:
    """Null instead of an empty array."""
    return F.when(F.size(col) > 0, col)


def distinct_children(
    rows: DataFrame, key: str, child: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row per (parent, child key) in a complete order."""
    rest = [c for c in rows.columns if c != key and c not in child]
    best = rows.groupBy(key, *child).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return best.select(key, *child, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_non_null(value: Column, order: Sequence[str]) -> Column:
    """Aggregate: the first non-null value in a given order."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))


def constant_list(**values: object) -> Column:
    """One-element array of constants, the same for every row."""
    return F.array(F.struct(*[_lit(v).alias(k) for k, v in values.items()]))


def _lit(value: object) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(None).cast("string") if value is None else F.lit(value)


def dimension_list(rows: Sequence[Mapping[str, object]], computed: Mapping[str, object]) -> Column:
    """A constant dimension as an array, with columns computed per entry from the row.

    ``computed`` maps a name to a function from the entry to a Column.
    """
    return F.array(
        *[
            F.struct(
                *[F.lit(v).alias(k) for k, v in row.items()],
                *[make(row).alias(name) for name, make in computed.items()],
            )
            for row in rows
        ]
    )


def json_array(text: Column, element: str) -> Column:
    """JSON text as an array: an object gives one element, anything unusable gives none."""
    trimmed = F.trim(text)
    many = F.from_json(trimmed, f"array<{element}>")
    one = F.from_json(trimmed, element)
    empty = F.array().cast(f"array<{element}>")
    return (
        F.when(trimmed.startswith("["), F.coalesce(many, empty))
        .when(trimmed.startswith("{") & _parses(trimmed), F.array(one))
        .otherwise(empty)
    )


def _parses(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def checked_array(text: Column, element: str) -> Column:
    """JSON text parsed once into ``items`` and, where it is not usable, a ``reject`` reason.

    As ``json_array``, but text that gives no list says why: it is no JSON, or JSON of another kind.
    Null, blank and JSON null stand for an empty list and are no rejects.
    """
    trimmed = F.trim(text)
    parsed = F.try_parse_json(trimmed)
    kind = F.regexp_extract(F.schema_of_variant(parsed), "^[A-Z]+", 0)
    items = json_array(text, element)
    reason = (
        F.when(trimmed.isNull() | (trimmed == ""), None)
        .when(parsed.isNull(), "not JSON")
        .when(kind == "VOID", None)
        .when(~kind.isin("ARRAY", "OBJECT"), "no list")
    )
    return F.struct(items.alias("items"), reason.alias("reject"))


def split_rejects(
    df: DataFrame, key: Sequence[str], column: str, element: str, name: str = "items"
) -> tuple[DataFrame, DataFrame]:
    """All rows with the parsed list as ``name``, and (key, text, reason) of the unusable texts.

    The texts are parsed once: both results read the same written rows.
    """
    parsed = pin(df.withColumn("_checked", checked_array(F.col(column), element)))
    rows = parsed.withColumn(name, F.col("_checked.items")).drop("_checked")
    rejects = parsed.filter(F.col("_checked.reject").isNotNull()).select(
        *key, F.col(column).alias("text"), F.col("_checked.reject").alias("reason")
    )
    return rows, rejects


def json_text(col: Column, keep_nulls: bool) -> Column:
    """Struct or array as JSON text, with null fields kept or dropped."""
    return F.to_json(col, {"ignoreNullFields": "false" if keep_nulls else "true"})
