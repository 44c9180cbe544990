"""Attendance punches: ingest into the log, and sending of what is pending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import HR_RETRIES, PENDING
from outledger.functions.dates import iso_text, local_day
from outledger.operators.delivery import outcome_status, retry_fold
from outledger.operators.filters import split_valid
from outledger.operators.joins import anti
from outledger.operators.ranking import extreme_per_day
from outledger.operators.state import job_status

_c = F.col

DAY_KEY = ["employee_id", "punch_type", "punch_day"]


def new_punches(
    punches: DataFrame, log: DataFrame, now: Column, timezone: str | None = None
) -> DataFrame:
    """Log rows for the punches of one run.

    Complete punches only; the earliest check-in and latest check-out of a person
    and day; none for a person and day the log already has, even if a later run
    brings a better one.
    """
    good, _ = split_valid(punches, ["employee_id", "punch_time"])
    day = local_day(_c("punch_time"), timezone)
    best = extreme_per_day(good, day=day)
    known = log.select("employee_id", "punch_type", day.alias("punch_day"))
    fresh = anti(best, known, DAY_KEY)
    return fresh.select(
        "ref_id",
        "employee_id",
        "punch_type",
        "punch_time",
        now.alias("capture_time"),
        F.lit(PENDING).alias("push_status"),
    )


def punch_records(log: DataFrame) -> DataFrame:
    """Flat outgoing records, one per request."""
    return log.select(
        "ref_id",
        _c("employee_id").alias("EmployeeId"),
        _c("punch_type").alias("PunchType"),
        iso_text(_c("punch_time")).alias("PunchTime"),
        iso_text(_c("capture_time")).alias("CaptureDateTime"),
    )


def push_outcomes(queue: DataFrame, attempts: DataFrame) -> DataFrame:
    """Outcome per queued record: retried on server errors, stopped by a 4xx."""
    folded = retry_fold(
        attempts, ["ref_id"], HR_RETRIES, stop_on_4xx=True, check_body=False
    )
    sent = queue.select("ref_id").join(folded, "ref_id", "left")
    return sent.select("ref_id", F.coalesce("ok", F.lit(False)).alias("ok"), "http_status")


def apply_outcomes(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The log with pushed and failed records marked."""
    hit = outcomes.select("ref_id", outcome_status(_c("ok")).alias("_new"))
    return (
        log.join(hit, "ref_id", "left")
        .withColumn("push_status", F.coalesce("_new", "push_status"))
        .select(*log.columns)
    )


def job_row(outcomes: DataFrame, job: str, kind: str, started: Column, done: Column) -> DataFrame:
    """The job-log row of a finished run."""
    failed = F.count_if(~_c("ok"))
    return outcomes.agg(job_status(failed).alias("last_status")).select(
        F.lit(job).alias("job_key"),
        F.lit(kind).alias("punch_type"),
        started.alias("last_triggered_at"),
        done.alias("last_completed_at"),
        "last_status",
        done.alias("updated_at"),
    )
