"""Text search through a stored table of trigrams.

A posting says that a column of a record holds three consecutive characters, in lower case. A search of
three characters or more reads the postings of its own trigrams only, intersects them per record and
column, and tests the few records left literally. Shorter texts have no trigram: they scan the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.functions.text import contains_any
from outledger.operators import filters

SIZE = 3
BUCKETS = 64


def grams_of(text: Column) -> Column:
    """Distinct trigrams of a text in lower case; none for shorter ones and null."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(low) - SIZE + 1)
    some = F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(SIZE))))
    return F.when(F.length(low) >= SIZE, some).otherwise(F.array().cast("array<string>"))


def bucket_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def store_postings(df: DataFrame, key: str, columns: Sequence[str], path: str) -> None:
    """Write the postings of some columns, in buckets by trigram and sorted within files."""
    found = F.array(*[F.struct(F.lit(c).alias("field"), grams_of(F.col(c)).alias("grams")) for c in columns])
    rows = df.select(F.col(key).alias("key"), F.inline(found)).select("key", "field", F.explode("grams").alias("gram"))
    dealt = rows.withColumn("bucket", bucket_of(F.col("gram")))
    # A frequent trigram spreads over several files of its bucket; files hold ranges of trigrams.
    dealt.repartitionByRange("bucket", "gram", "key").sortWithinPartitions("bucket", "gram").write.partitionBy(
        "bucket"
    ).parquet(path)


def search(spark: SparkSession, df: DataFrame, key: str, columns: Sequence[str], text: str, path: str) -> DataFrame:
    """Rows of ``df`` of which one of the columns contains ``text``, as ``filters.search`` finds them.

    ``path`` holds the postings of the same rows and columns.
    """
    own = spark.range(1).select(F.explode(grams_of(F.lit(text))).alias("gram"))
    found = own.select("gram", bucket_of(F.col("gram")).alias("bucket")).collect()
    if not found:
        return filters.search(df, columns, text)
    grams, buckets = [r["gram"] for r in found], sorted({r["bucket"] for r in found})
    postings = spark.read.parquet(path).where(F.col("bucket").isin(buckets) & F.col("gram").isin(grams))
    whole = postings.groupBy("key", "field").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
    hits = whole.select(F.col("key").alias(key)).distinct()
    return df.join(hits, key, "left_semi").where(contains_any([F.col(c) for c in columns], text))
