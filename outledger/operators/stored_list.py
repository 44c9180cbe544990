"""Ordered lists that are written once and paged at any depth through a sparse rank index.

The rows are range-sorted into files of bounded length; the index holds, for every file, its first key
and the number of rows in it and before it. A page reads the index and the files its rows lie in. With
a filter, the rows that pass are counted per file once, from the filter's columns only, and a page
again reads just the files it falls into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.operators.paging import clamp

#: Rows of a file; the index has one row a file, so choose more for lists of very many rows.
FILE_ROWS = 100_000


def store_list(df: DataFrame, path: str, order: Sequence[str], file_rows: int = FILE_ROWS) -> StoredList:
    """Write ``df`` in a unique order, with its index. ``path`` must be new."""
    base = path.rstrip("/")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("_slot", F.monotonically_increasing_id())
    numbered.write.option("maxRecordsPerFile", file_rows).parquet(f"{base}/rows")
    rows = df.sparkSession.read.schema(numbered.schema).parquet(f"{base}/rows")
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min("_slot").alias("slot"), F.min(F.struct(*order)).alias("first")
    )
    _with_starts(files, "slot").write.parquet(f"{base}/index")
    return StoredList(df.sparkSession, base)


def _with_starts(files: DataFrame, by: str) -> DataFrame:
    """One row a file with ``start``, the rows before it: running sums over the ordered files."""
    session, ordered = files.sparkSession, files.orderBy(by)
    starts, before = [], 0
    for row in ordered.select("file", "n").toLocalIterator():
        starts.append((row["file"], before))
        before += row["n"]
    return files.join(session.createDataFrame(starts, "file string, start bigint"), "file")


class StoredList:
    """A list that ``store_list`` has written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows = spark.read.parquet(f"{self.path}/rows")
        self.index = spark.read.parquet(f"{self.path}/index")

    def total(self) -> int:
        """All rows, from the index."""
        return self.index.agg(F.sum("n")).first()[0] or 0

    def count_where(self, name: str, condition: Column) -> None:
        """Count the rows that pass a filter in every file, and keep the counts under a name."""
        passing = self.rows.where(condition).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
        slots = self.index.select("file", "slot")
        _with_starts(passing.join(slots, "file"), "slot").write.parquet(f"{self.path}/counts-{name}")

    def page(
        self, page: int | None = 1, limit: int | None = None, name: str | None = None, condition: Column | None = None
    ) -> DataFrame:
        """One page in order, with ``total_count``; of a filter that ``count_where`` has counted, if named."""
        page, limit = clamp(page, limit)
        skip = (page - 1) * limit
        index = self.index if name is None else self.spark.read.parquet(f"{self.path}/counts-{name}")
        total = index.agg(F.sum("n")).first()[0] or 0
        hit = index.where((F.col("start") < skip + limit) & (F.col("start") + F.col("n") > skip))
        files = hit.select("file", "start").orderBy("start").collect()
        shown = self.rows.limit(0)
        if files:
            shown = self.spark.read.schema(self.rows.schema).parquet(*[f["file"] for f in files])
            if condition is not None:
                shown = shown.where(condition)
            shown = shown.orderBy("_slot").offset(skip - files[0]["start"]).limit(limit)
        return shown.drop("_slot").withColumn("total_count", F.lit(total).cast("bigint"))
