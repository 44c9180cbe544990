"""Keyed state: upserts, status tracking, run board, job log, and their snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outledger.fixed_values import FAILED, FINAL_STATUSES, PENDING, PUSHED, PUSHING
from outledger.functions.text import truncate_text


def upsert(
    state: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    keep_old_if_null: Sequence[str] = (),
    never_update: Sequence[str] = (),
    insert: bool = True,
) -> DataFrame:
    """The next state: updated, inserted and untouched rows.

    ``updates`` has at most one row per key. A column it lacks keeps its value;
    ``keep_old_if_null`` columns keep it when the new value is null;
    ``never_update`` columns are set on insert only. Without ``insert``, new keys are ignored.
    """
    values = [c for c in updates.columns if c not in key]
    changes = updates.select(
        *[F.col(k).alias(f"_k_{k}") for k in key],
        *[F.col(c).alias(f"_u_{c}") for c in values],
        F.lit(True).alias("_hit"),
    )
    match = [state[k] == changes[f"_k_{k}"] for k in key]
    joined = state.withColumn("_old", F.lit(True)).join(changes, match, "full" if insert else "left")

    def merged(c: str) -> Column:
        if c in key:
            return F.coalesce(F.col(c), F.col(f"_k_{c}"))
        if c not in values:
            return F.col(c)
        new = F.col(f"_u_{c}")
        if c in keep_old_if_null:
            new = F.coalesce(new, F.col(c))
        if c in never_update:
            new = F.when(F.col("_old"), F.col(c)).otherwise(new)
        return F.when(F.col("_hit"), new).otherwise(F.col(c))

    return joined.select(*[merged(c).alias(c) for c in state.columns])


def update_existing(state: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """As ``upsert``, but keys the state does not know are ignored."""
    return upsert(state, updates, [key], insert=False)


def latest_per_record(updates: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last of several updates to the same key, which is all a serial replay leaves."""
    rest = [c for c in updates.columns if c not in key and c != order]
    last = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return last.select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def status_updates(
    results: DataFrame, master: str, status: Column, error: Column, now: Column
) -> DataFrame:
    """Rows for the record-status table from (record_key, ...) results."""
    return results.select(
        F.lit(master).alias("master_type"),
        "record_key",
        status.alias("push_status"),
        F.when(status.isin(*FINAL_STATUSES), now).alias("last_pushed_at"),
        truncate_text(error).alias("error_message"),
        now.alias("updated_at"),
    )


def upsert_status(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Status upsert: the last push time survives updates that carry none."""
    return upsert(state, updates, ["master_type", "record_key"], ["last_pushed_at"])


def folded_results(updates: DataFrame, order: str) -> DataFrame:
    """One update per key from many: the last one, with the latest push time any of them carries."""
    key = ["master_type", "record_key"]
    rest = [c for c in updates.columns if c not in key and c not in (order, "last_pushed_at")]
    carried = F.when(F.col("last_pushed_at").isNotNull(), F.col(order))
    last = updates.groupBy(*key).agg(
        F.max_by(F.struct(*rest), F.col(order)).alias("_last"),
        F.max_by("last_pushed_at", carried).alias("last_pushed_at"),
    )
    fields = [F.col(f"_last.{c}").alias(c) for c in rest]
    return last.select(*key, *fields, "last_pushed_at")


def bulk_upsert(state: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """Many results at once, later ones win; equal to applying them one by one."""
    return upsert_status(state, folded_results(updates, order))


def results_to_updates(results: DataFrame, master: str, now: Column) -> DataFrame:
    """(record_key, success, error_message) to status rows."""
    status = F.when(F.col("success"), PUSHED).otherwise(FAILED)
    return status_updates(results, master, status, F.col("error_message"), now)


def in_flight_updates(keys: DataFrame, master: str, now: Column) -> DataFrame:
    """Status rows that set every given key to pushing."""
    return status_updates(keys.distinct(), master, F.lit(PUSHING), F.lit(None).cast("string"), now)


def mark_in_flight(state: DataFrame, keys: DataFrame, master: str, now: Column) -> DataFrame:
    """Set every given key to pushing; its last push time stays, its error goes."""
    return upsert_status(state, in_flight_updates(keys, master, now))


def fold_events(
    events: DataFrame, key: str, order: Sequence[str], status: str, time: str, error: str
) -> DataFrame:
    """Current status, error and last push time per key from a log of status events."""
    last = F.max_by(F.struct(F.col(status), F.col(error)), F.struct(*order))
    final = F.max(F.when(F.col(status).isin(*FINAL_STATUSES), F.col(time)))
    return (
        events.groupBy(key)
        .agg(last.alias("_last"), final.alias("last_pushed_at"), F.max(time).alias("updated_at"))
        .select(
            F.col(key).cast("string").alias("record_key"),
            F.col(f"_last.{status}").alias("push_status"),
            "last_pushed_at",
            truncate_text(F.col(f"_last.{error}")).alias("error_message"),
            "updated_at",
        )
    )


def board_seed(board: DataFrame, datasets: Sequence[tuple[str, str]], now: Column) -> DataFrame:
    """The board with a row for every dataset; rows it already has are left alone."""
    spark = board.sparkSession
    rows = F.array(
        *[F.struct(F.lit(t).alias("sync_type"), F.lit(n).alias("display_name")) for t, n in datasets]
    )
    wanted = spark.range(1).select(F.inline(rows))
    fresh = wanted.join(board, "sync_type", "left_anti").select(
        "sync_type", "display_name", F.lit(False).alias("is_pushed"), now.alias("updated_at")
    )
    return board.unionByName(fresh, allowMissingColumns=True)


def board_list(board: DataFrame, datasets: Sequence[tuple[str, str]]) -> DataFrame:
    """All dataset rows in board order."""
    place = F.array_position(F.array(*[F.lit(t) for t, _ in datasets]), F.col("sync_type"))
    return board.orderBy(place, "sync_type")


def board_running(board: DataFrame, datasets: DataFrame, now: Column) -> DataFrame:
    """Mark datasets as running."""
    updates = datasets.select(
        "sync_type", F.lit("Running").alias("last_status"), now.alias("updated_at")
    )
    return update_existing(board, updates, "sync_type")


def board_result(board: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Store run results: (sync_type, success, partial, total, ok and failed counts, error)."""
    updates = results.select(
        "sync_type",
        F.col("success").alias("is_pushed"),
        "partial",
        F.when(F.col("success"), "Success").otherwise("Failed").alias("last_status"),
        now.alias("last_pushed_at"),
        "total_records",
        "success_count",
        "failed_count",
        truncate_text(F.col("error_message")).alias("error_message"),
        now.alias("updated_at"),
    )
    return update_existing(board, updates, "sync_type")


def update_by_ids(log: DataFrame, ids: DataFrame, key: str, status: str) -> DataFrame:
    """Set the status of the listed rows, leave the others."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    return (
        log.join(hit, key, "left")
        .withColumn(
            "push_status", F.when(F.col("_hit"), status).otherwise(F.col("push_status"))
        )
        .select(*log.columns)
    )


def job_log_upsert(log: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per job: trigger, completion and status are replaced, its kind is not."""
    return upsert(log, runs, ["job_key"], never_update=["punch_type"])


def job_status(failed: Column) -> Column:
    """Final status of a finished job from its number of failed records."""
    return F.when(failed > 0, "CompletedWithErrors").otherwise("Completed")


def pending_queue(log: DataFrame, kind: str, *order: str) -> DataFrame:
    """Rows of one kind that still have to be sent, sorted only when an order is given."""
    waiting = (F.col("punch_type") == kind) & F.col("push_status").isin(PENDING, FAILED)
    queue = log.filter(waiting)
    return queue.orderBy(*order) if order else queue


def unprocessed_to_failed(
    log: DataFrame, fetched: DataFrame, processed: DataFrame, key: str
) -> DataFrame:
    """After an abort, what was fetched but not processed becomes failed."""
    left_over = fetched.select(key).join(processed.select(key), key, "left_anti")
    return update_by_ids(log, left_over, key, FAILED)


def changed_records(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Records that are new or differ from the previous snapshot in any column."""
    renamed = previous.select(*[F.col(c).alias(f"_p_{c}") for c in current.columns])
    same = current[key] == renamed[f"_p_{key}"]
    for c in current.columns:
        if c != key:
            same = same & current[c].eqNullSafe(renamed[f"_p_{c}"])
    return current.join(renamed, same, "left_anti")


class Snapshots:
    """Versioned Parquet snapshots of one state table, for a single writer.

    The table is kept in parts (one per dataset, or a single one named ''). A write makes a new
    folder for one part; appending its name to a small commit table makes it current. The folders of
    other parts stay as they are, files in use are never overwritten, and a failed write leaves the
    previous version current.
    """

    COMMITS = "version bigint, part string, folder string"

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], self.COMMITS)

    def version(self) -> int:
        """Number of the current version, 0 before the first."""
        return self._commits().agg(F.max("version")).first()[0] or 0

    def folders(self) -> dict[str, str]:
        """The current folder of every part."""
        latest = self._commits().groupBy("part").agg(F.max_by("folder", "version").alias("folder"))
        return {row["part"]: row["folder"] for row in latest.collect()}

    def read(self, part: str | None = None) -> DataFrame:
        """The current state of one part or of all, empty before the first version."""
        folders = self.folders()
        wanted = [f for p, f in sorted(folders.items()) if part is None or p == part]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{folder}" for folder in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, state: DataFrame, part: str = "") -> int:
        """Make ``state`` the next version of one part."""
        version = self.version() + 1
        folder = f"v{version:08d}"
        state.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        commit = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"),
            F.lit(part).alias("part"),
            F.lit(folder).alias("folder"),
        )
        commit.write.mode("append").parquet(f"{self.path}/commits")
        return version
