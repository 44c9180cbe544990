"""Replies to sent batches, judged within a time bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_REPLY = "No reply in time"


def judged(
    sent: DataFrame, replies: DataFrame, within: str = "30 seconds", lateness: str = "1 minute"
) -> DataFrame:
    """``batch_no, ok, error_message`` of every sent batch: its replies in time, else a failure.

    ``sent`` is a stream of (batch_no, sent_at), ``replies`` one of (batch_no, replied_at, ok,
    error_message). A reply counts if it came at or after the sending and no later than ``within``
    after it; a batch without one fails once the watermark of both streams has passed that bound, so
    the state holds only batches that still wait. ``lateness`` is how far rows may arrive out of order.
    A batch with several replies in time gets a row for each.
    """
    left = sent.select("batch_no", F.col("sent_at").cast("timestamp").alias("sent_at"))
    right = replies.select(
        F.col("batch_no").alias("_of"), F.col("replied_at").cast("timestamp").alias("replied_at"), "ok", "error_message"
    )
    left, right = left.withWatermark("sent_at", lateness), right.withWatermark("replied_at", lateness)
    in_time = (
        (F.col("batch_no") == F.col("_of"))
        & (F.col("replied_at") >= F.col("sent_at"))
        & (F.col("replied_at") <= F.col("sent_at") + F.expr(f"interval {within}"))
    )
    joined = left.join(right, in_time, "leftOuter")
    silent = F.col("_of").isNull()
    return joined.select(
        "batch_no",
        F.when(silent, F.lit(False)).otherwise(F.col("ok")).alias("ok"),
        F.when(silent, F.lit(NO_REPLY)).otherwise(F.col("error_message")).alias("error_message"),
    )
