"""Small helpers shared by the text operators.

Input contract of every operator: only the named id and text columns are read, so other columns,
also ones that clash with an operator's own names, never matter. Rows with equal ids are treated
row by row unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the white space that separates words, as bytes.
BLANKS = b" \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **more: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (string) and further named columns of ``df``, nothing else."""
    named = {"doc_id": F.col(f"`{doc_id}`").cast("long"), "text": F.col(f"`{text}`").cast("string")}
    named |= {name: F.col(f"`{source}`") for name, source in more.items()}
    return df.select(*(col.alias(name) for name, col in named.items()))


def text_key() -> Column:
    """Hash of the column ``text``: with the id it names a document even where ids repeat."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())


def filtered(
    df: DataFrame, keys: DataFrame, how: str, doc_id: str, text: str, also: str | None = None
) -> DataFrame:
    """Rows of ``df``, all columns, with (left_semi) or without (left_anti) a match in ``keys``.

    ``keys`` holds ``doc_id, text_key``; null ids match null ids. The column ``also`` of ``df``, if
    named, is hashed into the text key. Returns the rows as the struct ``row`` beside the keys.
    """
    whole = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    keyed = whole.select(
        "row", F.col("row")[doc_id].cast("long").alias("doc_id"), F.col("row")[text].cast("string").alias("text")
    ).withColumn("text_key", text_key())
    if also is not None:
        keyed = keyed.withColumn("text_key", F.xxhash64("text_key", F.col("row")[also].cast("string")))
    other = keys.select(F.col("doc_id").alias("of_doc"), F.col("text_key").alias("of_key"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_key"))
    return keyed.drop("text").join(other, same, how)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough to be turned into Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, Iterable]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a batch as a dict of Python lists on both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch.to_pydict()), schema=target)

    target = arrow_schema(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def byte_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8 bytes; none for null."""
    return encoded(text).split() if text else []


def encoded(text: str | None) -> bytes:
    """UTF-8 bytes, empty for null; lone surrogates, which UTF-8 cannot hold, become '?'."""
    return text.encode("utf-8", "replace") if text else b""


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
