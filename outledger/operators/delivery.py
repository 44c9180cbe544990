"""Response logs to outcomes, and outcomes to per-record results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outledger.fixed_values import (
    BODY_CHECKS,
    CHILD_FAILED_TEXT,
    ERROR_MARKS,
    FAILED,
    NOT_FOUND_TEXT,
    NOT_MAPPED_TEXT,
    PUSHED,
)
from outledger.functions.text import parent_of


def body_failed(body: Column, marks: Sequence[str] = ERROR_MARKS) -> Column:
    """Whether the JSON body of an accepted request reports an error.

    An error is a false success flag, an 'error' status, a list with an element
    whose success flag is false, or one of the marks anywhere in the text. Flags
    are compared as JSON, so the text "false" is not the value false.
    """
    parsed = F.try_parse_json(body)
    text = F.lower(body)
    failed = F.lit(False)
    for mark in marks:
        failed = failed | text.contains(mark)

    def field(source: Column, name: str) -> Column:
        return F.to_json(F.try_variant_get(source, f"$.{name}", "variant"))

    for name, bad in BODY_CHECKS:
        failed = failed | F.coalesce(field(parsed, name) == bad, F.lit(False))
    items = F.try_variant_get(parsed, "$", "array<variant>")
    bad_item = F.exists(
        items, lambda item: F.coalesce(field(item, "success") == "false", F.lit(False))
    )
    failed = failed | F.coalesce(bad_item, F.lit(False))
    return parsed.isNotNull() & F.coalesce(failed, F.lit(False))


def accepted(status: Column) -> Column:
    """Whether the transport succeeded."""
    return F.coalesce((status >= 200) & (status < 300), F.lit(False))


def classify_response(df: DataFrame, status: str = "http_status", body: str = "body") -> DataFrame:
    """Adds ``ok``: accepted, and no error reported in the body."""
    return df.withColumn("ok", accepted(F.col(status)) & ~body_failed(F.col(body)))


# HTTP status codes lie below this.
_CODES = 2048


def retry_fold(
    attempts: DataFrame,
    keys: Sequence[str],
    max_attempts: int,
    stop_on_4xx: bool,
    check_body: bool,
) -> DataFrame:
    """Final outcome per request from its attempts.

    Attempts end with the first accepted one (or the first 4xx, if that stops);
    otherwise the last allowed attempt decides and the request is exhausted.
    Later attempts in the log are counted, not used. Errors reported in a body
    are final: they are judged on the accepted attempt. Number, status and the
    judgement of the body are packed into one number that both aggregates carry;
    bodies themselves are not grouped, ``used_bodies`` fetches those that decided.
    Of several log rows of one attempt the lower status counts if it ended the
    request, else the higher.
    """
    status, number = F.col("http_status"), F.col("attempt")
    ends = accepted(status)
    if stop_on_4xx:
        ends = ends | ((status >= 400) & (status < 500))
    allowed = number <= max_attempts
    bad_body = F.coalesce(body_failed(F.col("body")), F.lit(False)) if check_body else F.lit(False)
    code = F.coalesce(status.cast("bigint"), F.lit(-1)) + 1  # 0 stands for no status
    packed = (number.cast("bigint") * _CODES + code) * 2 + bad_body.cast("bigint")
    folded = attempts.groupBy(*keys).agg(
        F.min(F.when(allowed & ends, packed)).alias("_end"),
        F.max(F.when(allowed, packed)).alias("_last"),
        F.max(number).alias("_logged"),
    )
    used = F.coalesce("_end", "_last")
    of = dict(attempts.dtypes)
    code_used = F.floor(used / 2) % _CODES
    attempt = F.floor(used / (2 * _CODES)).cast(of["attempt"])
    http = F.when(code_used > 0, code_used - 1).cast(of["http_status"])
    done = folded.select("*", attempt.alias("_attempt"), http.alias("_http"))
    good = accepted(F.col("_http")) & (used % 2 == 0)
    return done.select(
        *keys,
        F.col("_attempt").alias("attempts_used"),
        F.col("_http").alias("http_status"),
        good.alias("ok"),
        (F.col("_end").isNull() & (F.col("_attempt") >= max_attempts)).alias("exhausted"),
        (F.col("_logged") - F.col("_attempt")).alias("ignored_attempts"),
    )


def used_bodies(outcomes: DataFrame, attempts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``outcomes`` with the body of the attempt that decided; the least one where it was logged twice."""
    bodies = attempts.groupBy(*keys, F.col("attempt").alias("attempts_used")).agg(F.min("body").alias("body"))
    return outcomes.join(bodies, [*keys, "attempts_used"], "left")


def wait_report(
    outcomes: DataFrame, keys: Sequence[str], base_ms: int, linear: bool
) -> DataFrame:
    """Waiting time implied by the attempts used: base*k after attempt k, or a fixed pause."""
    pauses = (F.col("attempts_used") - 1).cast("bigint")
    wait = pauses * (pauses + 1) / 2 * base_ms if linear else pauses * base_ms
    return outcomes.groupBy(*keys).agg(
        F.sum(wait.cast("bigint")).alias("wait_ms"),
        F.sum(pauses).alias("retries"),
        F.count("*").alias("requests"),
    )


def error_text(text: Column, structure: Column) -> Column:
    """Error as text: text as it is, a structure as JSON."""
    return F.coalesce(text, F.to_json(structure))


def failed_keys_of(failures: DataFrame, codes: str, error: str, order: str) -> DataFrame:
    """(record_key, error_message) of all failed batches; the last error of a key wins."""
    each = failures.select(F.explode(codes).alias("record_key"), error, order)
    return each.groupBy("record_key").agg(F.max_by(error, order).alias("error_message"))


def reconcile(requested: DataFrame, failed: DataFrame) -> DataFrame:
    """Requested keys with success and error; keys outside the request are ignored."""
    return (
        requested.select("record_key")
        .distinct()
        .join(failed.withColumn("_bad", F.lit(True)), "record_key", "left")
        .select("record_key", F.col("_bad").isNull().alias("success"), "error_message")
    )


def reconcile_by_prefix(requested: DataFrame, failed_children: DataFrame) -> DataFrame:
    """A parent fails as soon as one of its composite child keys failed."""
    parents = failed_children.select(parent_of(F.col("child_key")).alias("record_key"))
    return reconcile(
        requested, parents.distinct().withColumn("error_message", F.lit(CHILD_FAILED_TEXT))
    )


def reconcile_missing(
    requested: DataFrame, fetched: DataFrame, mapped: DataFrame, failed: DataFrame
) -> DataFrame:
    """Outcome of every requested key: not found, not mapped, failed or succeeded."""

    def seen(df: DataFrame, name: str) -> DataFrame:
        return df.select("record_key").distinct().withColumn(name, F.lit(True))

    joined = (
        requested.select("record_key")
        .distinct()
        .join(seen(fetched, "_fetched"), "record_key", "left")
        .join(seen(mapped, "_mapped"), "record_key", "left")
        .join(failed.withColumn("_failed", F.lit(True)), "record_key", "left")
    )
    text = (
        F.when(F.col("_fetched").isNull(), NOT_FOUND_TEXT)
        .when(F.col("_mapped").isNull(), NOT_MAPPED_TEXT)
        .when(F.col("_failed"), F.col("error_message"))
    )
    good = F.col("_fetched").isNotNull() & F.col("_mapped").isNotNull() & F.col("_failed").isNull()
    return joined.select("record_key", good.alias("success"), text.alias("error_message"))


def run_outcome(ok_batches: Column, failed_batches: Column) -> Column:
    """A run fails when every batch failed; with some failures it completed with failures."""
    return (
        F.when((ok_batches == 0) & (failed_batches > 0), "failed")
        .when(failed_batches > 0, "completed with failures")
        .otherwise("success")
    )


def outcome_status(ok: Column) -> Column:
    """Record status that follows from an outcome."""
    return F.when(ok, PUSHED).otherwise(FAILED)
