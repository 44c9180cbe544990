"""Global positions, delivery batches and outbox files, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.session import pin

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_position(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """0-based ``pos`` of every row in a unique order, and the row count as ``total``.

    The rows are written once, so what leads to them runs once; only the order columns and a row
    number are range-partitioned and sorted, by the whole order, so equal leading values still spread.
    Positions then join the rows by number. One count per partition comes to the driver and goes back
    as a small table. Rows that have no other columns are sorted as they are.
    """
    if set(df.columns) - set(order):
        rows = pin(df.withColumn("_row", F.monotonically_increasing_id()))
        placed = _positions(rows.select(*order, "_row"), order)
        return rows.join(placed.select("_row", "pos", "total"), "_row").drop("_row")
    return _positions(df, order)


def _positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    pinned = pin(ranged).withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    rows = pinned.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    before, starts = 0, []
    for row in rows:
        starts.append((row["_part"], before))
        before += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    total = F.lit(before).cast("bigint")
    row_in_part = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    return (
        pinned.join(offsets, "_part")
        .withColumn("pos", F.col("_start") + row_in_part)
        .withColumn("total", total)
        .drop("_slot", "_part", "_start")
    )


def assign_batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Batch number, size, range label and end mark of every row in a unique order."""
    rows = with_position(df, order)
    batch = F.floor(F.col("pos") / size)
    last = F.least((F.col("batch_no")) * size, F.col("total"))
    first = (F.col("batch_no") - 1) * size + 1
    return (
        rows.withColumn("batch_no", batch + 1)
        .withColumn("batch_size", last - first + 1)
        .withColumn("total_batches", F.ceil(F.col("total") / size))
        .withColumn("record_range", F.concat_ws("-", first, last))
        .withColumn("batch_end", F.col("pos") == F.col("total") - 1)
    )


def delivery_plan(df: DataFrame, size: int) -> DataFrame:
    """One row per batch, spread over tasks. All of it follows from the row count, one number."""
    total = df.count()
    n = -(-total // size)
    batches = df.sparkSession.range(1, n + 1).withColumnRenamed("id", "batch_no")
    first = (F.col("batch_no") - 1) * size + 1
    last = F.least(F.col("batch_no") * size, F.lit(total))
    return batches.select(
        "batch_no",
        (last - first + 1).alias("batch_size"),
        F.concat_ws("-", first, last).alias("record_range"),
        F.lit(n).cast("bigint").alias("total_batches"),
        (last == total).alias("is_last"),
    )


def mark_end(df: DataFrame, order: Sequence[str], name: str = "batch_end") -> DataFrame:
    """True on the one row that comes last in a unique order: a maximum, not a sort."""
    place = F.struct(*order)
    return df.withColumn(name, place == df.agg(F.max(place)).scalar())


def outbox_write(
    batches: DataFrame, path: str, dataset: str, document: Column, group_batches: int = 1000
) -> None:
    """Documents as JSON lines, one folder per group of consecutive batches.

    A range shuffle on position keeps the batches of a group together and spreads
    one large group over several files, in order.
    """
    (
        batches.select(
            F.lit(dataset).alias("dataset"),
            F.floor((F.col("batch_no") - 1) / group_batches).alias("batch_group"),
            "batch_no",
            "pos",
            "batch_end",
            document.alias("document"),
        )
        .repartitionByRange("batch_group", "pos")
        .sortWithinPartitions("batch_group", "pos")
        .write.mode("errorifexists")
        .partitionBy("dataset", "batch_group")
        .json(path)
    )
