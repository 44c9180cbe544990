"""The run board: one row per dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import DATASETS
from outledger.operators.aggregates import delivery_counts
from outledger.operators.delivery import run_outcome
from outledger.operators.state import board_list, board_result, board_running, board_seed

_c = F.col


def run_results(batches: DataFrame) -> DataFrame:
    """Board results per dataset from its batches (sync_type, ok, size).

    A run with some failures still counts as a success; ``partial`` tells them apart.
    """
    counts = delivery_counts(batches, ["sync_type"], "ok", "size")
    outcome = run_outcome(_c("success_batches"), _c("failed_batches"))
    all_failed = F.format_string("All %d batch(es) failed.", _c("failed_batches"))
    return counts.select(
        "sync_type",
        (outcome != "failed").alias("success"),
        (outcome == "completed with failures").alias("partial"),
        _c("total_records"),
        _c("success_records").alias("success_count"),
        _c("failed_records").alias("failed_count"),
        F.when(outcome == "failed", all_failed).alias("error_message"),
    )


def board_after_runs(board: DataFrame, batches: DataFrame, started: Column, done: Column):
    """Seed, mark as running, store results, list in board order."""
    seeded = board_seed(board, DATASETS, started)
    running = board_running(seeded, batches.select("sync_type").distinct(), started)
    finished = board_result(running, run_results(batches), done)
    return board_list(finished, DATASETS)
