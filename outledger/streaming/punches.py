"""Punch streams: ingest into the log, bounded-state dedupe, running day counts."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from outledger.functions.dates import local_day
from outledger.operators.filters import missing_reason, split_valid
from outledger.operators.joins import anti
from outledger.plans.attendance import DAY_KEY, new_punches
from outledger.session import pin, run_dir
from outledger.sources.schemas import PUNCH_LOG

PUNCH = "ref_id bigint, employee_id string, punch_type string, punch_time timestamp_ntz"
LOG = f"{PUNCH_LOG}, punch_day date"


def punch_files(
    spark: SparkSession, path: str, schema: str = PUNCH, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of JSON punch files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The punch log, empty before its first batch."""
    return read_table(spark, path, LOG)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet folder, empty before it is first written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def ingest_batch(
    punches: DataFrame, log_path: str, now: Column, timezone: str | None = None, plan: str | None = None
) -> int:
    """Append the accepted punches of one batch to the log; returns how many the batch accepts.

    Only the log days that the batch holds punches of are read: the distinct days join the log on
    its partition column. With ``plan``, a folder of the batch's own, the accepted rows are written
    there first: a replay, also after a partial append, takes them from there and adds just what the
    log lacks, so it accepts and reports the same rows as the first attempt.
    """
    spark = punches.sparkSession
    day = local_day(F.col("punch_time"), timezone)
    days = pin(punches.select(day.alias("punch_day")).where("punch_day is not null").distinct())
    if days.isEmpty():
        return 0
    log = read_log(spark, log_path).join(days, "punch_day", "left_semi")
    plan = plan or f"{run_dir(spark)}/punches-{uuid.uuid4().hex}"
    if not written(spark, plan):
        fresh = new_punches(punches, log, now, timezone).withColumn("punch_day", day)
        seen = Observation()
        counted = fresh.withColumn("ref_id", F.col("ref_id").cast("string")).observe(
            seen, F.count(F.lit(1)).alias("n")
        )
        counted.write.mode("overwrite").parquet(plan)
        accepted = seen.get.get("n", 0)
    else:
        accepted = spark.read.parquet(plan).count()
    rows = spark.read.schema(LOG).parquet(plan)
    missing = anti(rows, log, DAY_KEY).select(*rows.columns)
    missing.write.mode("append").partitionBy("punch_day").parquet(log_path)
    return accepted


def written(spark: SparkSession, path: str) -> bool:
    """Whether a folder has been written to its end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def side_paths(log_path: str) -> tuple[str, str]:
    """Folders beside the log: rejected punches with their reason, and counts per batch."""
    base = log_path.rstrip("/")
    return f"{base}_rejected", f"{base}_counts"


COUNTS = "arrived bigint, rejected bigint, inserted bigint, duplicate bigint, batch bigint"


def ingest_stream(
    punches: DataFrame,
    log_path: str,
    checkpoint: str,
    now: Column,
    timezone: str | None = None,
) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint remembers what was read.

    Every batch also writes its rejected punches with their reason and one row of counts (arrived,
    rejected, inserted, duplicate) into folders of its own beside the log, which a replay replaces by
    equal ones. Arrived and rejected rows are observed on the write that stores the batch, inserted ones
    on the write of its plan; the log is not counted.
    """
    rejected_path, counts_path = side_paths(log_path)
    required = ["employee_id", "punch_time"]

    def run(batch: DataFrame, number: int) -> None:
        seen = Observation()
        arrived = pin(
            batch.observe(
                seen,
                F.count(F.lit(1)).alias("arrived"),
                F.count_if(missing_reason(required).isNotNull()).alias("rejected"),
                F.bit_xor(F.xxhash64(*batch.columns)).alias("print"),
            )
        )
        n, bad = seen.get.get("arrived", 0), seen.get.get("rejected", 0)
        good, rejected = split_valid(arrived, required)
        rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        # Named by the rows too: another run's batch of that number is another batch.
        plan = f"{log_path.rstrip('/')}_plans/{number}-{n}-{(seen.get.get('print') or 0) & (2**64 - 1):016x}"
        inserted = ingest_batch(good, log_path, now, timezone, plan)
        counts = (F.lit(v).cast("bigint").alias(c) for c, v in
                  (("arrived", n), ("rejected", bad), ("inserted", inserted), ("duplicate", n - bad - inserted)))
        arrived.sparkSession.range(1).select(*counts).write.mode("overwrite").parquet(f"{counts_path}/batch={number}")

    return (
        punches.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_counts(spark: SparkSession, log_path: str) -> DataFrame:
    """One row of counts per batch."""
    return read_table(spark, side_paths(log_path)[1], COUNTS)


def dedupe_stream(punches: DataFrame, lateness: str = "2 days") -> DataFrame:
    """First arrival per person, kind and day, with state bounded by the watermark.

    Rows later than ``lateness`` may go without a trace here; ``dedupe_to`` keeps them aside. This
    keeps arrival order; ``ingest_stream`` keeps the earliest or latest punch.
    """
    timed = punches.filter("employee_id is not null and punch_time is not null").select(
        "*",
        F.col("punch_time").cast("timestamp").alias("event_time"),
        F.to_date("punch_time").alias("punch_day"),
    )
    return (
        timed.withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(DAY_KEY)
        .drop("event_time")
    )


def dedupe_to(
    punches: DataFrame, path: str, late_path: str, checkpoint: str
) -> StreamingQuery:
    """First arrival per person, kind and day, exactly, however late a punch comes.

    The table at ``path`` is the state: a batch keeps the first of its own rows by ``ref_id`` and
    adds those whose person, kind and day the table does not know, reading only the days it
    touches. Punches of days before the latest one of earlier batches are also written to
    ``late_path``, one folder per batch, so that they can be counted. Each batch stores its own latest
    day beside it and compares with those of lower numbers, so a replay finds the same rows late.
    """
    newest_path = f"{late_path.rstrip('/')}_newest"

    def run(batch: DataFrame, number: int) -> None:
        timed = batch.filter("employee_id is not null and punch_time is not null")
        rows = pin(timed.withColumn("punch_day", F.to_date("punch_time")))
        spark = rows.sparkSession
        known = read_table(spark, path, rows.schema)
        newest = read_table(spark, newest_path, "newest date, batch bigint").where(F.col("batch") < number)
        late = rows.filter(F.col("punch_day") < newest.agg(F.max("newest")).scalar())
        rows.agg(F.max("punch_day").alias("newest")).write.mode("overwrite").parquet(f"{newest_path}/batch={number}")
        late.write.mode("overwrite").parquet(f"{late_path}/batch={number}")
        days = pin(rows.select("punch_day").distinct())
        seen = known.join(days, "punch_day", "left_semi").select(*DAY_KEY)
        rest = [c for c in rows.columns if c not in DAY_KEY]
        first = rows.groupBy(*DAY_KEY).agg(F.min_by(F.struct(*rest), "ref_id").alias("_row"))
        fresh = pin(first.join(seen, DAY_KEY, "left_anti").select(*DAY_KEY, "_row.*").select(*rows.columns))
        fresh.write.mode("append").partitionBy("punch_day").parquet(path)

    return (
        punches.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(log: DataFrame) -> DataFrame:
    """Running number of punches per kind, status and day, however late they come.

    State is days x kinds x statuses, small by nature, so no watermark drops a row.
    """
    day = F.to_date("punch_time").alias("punch_day")
    return log.groupBy(day, "punch_type", "push_status").agg(F.count("*").alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write an append-mode stream to Parquet until what has arrived is done."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def changes_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed rows of an update-mode stream, one folder per batch."""

    def run(batch: DataFrame, number: int) -> None:
        # A replayed batch replaces its own folder.
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(run)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_changes(changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The current value per key from the folders that ``changes_to`` wrote."""
    return changes.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))
