"""Audit roll-ups: batch and run summaries, request attempts.

Summaries hold counts; which companies are behind a count is a relation of its
own (``batch_outcomes``), since a list per endpoint would grow without bound.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.functions import alert_text, failure_reason, redact_secrets
from fiscora.operators.contract import ACCEPTED, DAILY_LIMIT, NO_CHANGE, QUARANTINE, RATE_LIMIT, REJECTED

FAILURE_EVENT = "job_failure"
SUCCESS, PARTIAL_SUCCESS, ERROR = "SUCCESS", "PARTIAL_SUCCESS", "ERROR"
BATCH = ("run_id", "endpoint")
COMPLETED, FAILED, PENDING = "completed", "failed", "pending"
REQUEST_COUNTERS = (
    "actual_requests",
    "successful_requests",
    "failed_requests",
    "rate_limit_requests",
    "retry_requests",
)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def batch_outcomes(planned: DataFrame, processed: DataFrame) -> DataFrame:
    """One row per planned or processed ``(run_id, endpoint, symbol)``.

    ``processed`` carries the ``route`` of each document and, optionally, its
    ``payload_class`` and ``reason``. Output adds ``planned, completed, no_change, failed,
    pending, stopped`` and ``reason``, why a key failed (the greatest text, should its documents
    differ), NULL otherwise. One aggregation over both inputs, combined map-side.
    """
    keys = [*BATCH, "symbol"]
    ok = F.col("route").isin(ACCEPTED, NO_CHANGE)
    bad = F.col("route").isin(REJECTED, QUARANTINE)
    stop = (
        F.col("payload_class").isin(RATE_LIMIT, DAILY_LIMIT) if "payload_class" in processed.columns else F.lit(False)
    )
    why = F.col("reason") if "reason" in processed.columns else F.lit(None).cast("string")
    zero = F.lit(0)
    rows = planned.select(
        *keys,
        F.lit(1).alias("planned"),
        *(zero.alias(n) for n in (COMPLETED, NO_CHANGE, FAILED, "stopped")),
        F.lit(None).cast("string").alias("reason"),
    ).unionByName(
        processed.select(
            *keys,
            zero.alias("planned"),
            _flag(ok).alias(COMPLETED),
            _flag(F.col("route") == NO_CHANGE).alias(NO_CHANGE),
            _flag(bad).alias(FAILED),
            _flag(stop).alias("stopped"),
            F.when(bad, why).alias("reason"),
        )
    )
    per_key = rows.groupBy(*keys).agg(
        *(F.max(n).alias(n) for n in ("planned", COMPLETED, NO_CHANGE, FAILED, "stopped", "reason"))
    )
    pending = (F.col("planned") == 1) & (F.col(COMPLETED) == 0) & (F.col(FAILED) == 0)
    return per_key.withColumn(PENDING, pending.cast("int"))


def pending_keys(planned: DataFrame, processed: DataFrame) -> DataFrame:
    """Planned keys that were neither completed nor failed.

    Processed keys are made distinct before the join, which needs the same shuffle:
    a company processed very often then weighs as much as any other.
    """
    keys = [*BATCH, "symbol"]
    done = processed.where(F.col("route").isin(ACCEPTED, NO_CHANGE, REJECTED, QUARANTINE))
    return planned.join(done.select(*keys).distinct(), keys, "left_anti")


def batch_summary(outcomes: DataFrame, *, allow_partial: bool = True) -> DataFrame:
    """Per run and endpoint: counts and status.

    SUCCESS when nothing failed or is pending; PARTIAL_SUCCESS in best-effort mode
    unless a rate limit stopped the batch; otherwise ERROR. A skipped document
    (no newer period) counts as completed.
    """

    def total(name: str) -> Column:
        return F.sum(name).cast("bigint").alias(name)

    counts = outcomes.groupBy(*BATCH).agg(
        total("planned"),
        total(COMPLETED),
        total(NO_CHANGE),
        total(FAILED),
        total(PENDING),
        (F.max("stopped") == 1).alias("stopped_early"),
    )
    whole = (F.col(FAILED) == 0) & (F.col(PENDING) == 0)
    partial = F.lit(allow_partial) & ~F.col("stopped_early")
    status = F.when(whole, SUCCESS).when(partial, PARTIAL_SUCCESS).otherwise(ERROR)
    return counts.select(
        *BATCH,
        status.alias("status"),
        F.col("planned").alias("planned_requests"),
        COMPLETED,
        F.col(NO_CHANGE).alias("watermark_skips"),
        FAILED,
        PENDING,
        "stopped_early",
    )


def attempt_metrics(attempts: DataFrame) -> DataFrame:
    """Per run and endpoint: source calls by outcome. Any status that is neither a
    success nor a rate limit is a failure; an attempt after the first is a retry."""
    status = F.col("status")
    ok, limited = status == "success", status.startswith("rate_limit")
    return attempts.groupBy(*BATCH).agg(
        F.count(F.lit(1)).alias("actual_requests"),
        F.count_if(ok).alias("successful_requests"),
        F.count_if(~ok & ~limited).alias("failed_requests"),
        F.count_if(limited).alias("rate_limit_requests"),
        F.count_if(F.col("attempt") > 1).alias("retry_requests"),
    )


def run_summary(summaries: DataFrame, metrics: DataFrame) -> DataFrame:
    """Per run: planned work, skips, request counters and status over its endpoints."""
    joined = summaries.join(metrics, list(BATCH), "left")
    trouble = F.col("status") != SUCCESS

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)

    return joined.groupBy("run_id").agg(
        F.when(F.bool_or(trouble), PARTIAL_SUCCESS).otherwise(SUCCESS).alias("status"),
        F.count(F.lit(1)).alias("endpoints"),
        F.count_if(F.col("status") == PARTIAL_SUCCESS).alias("partial_endpoints"),
        F.count_if(F.col("status") == ERROR).alias("failed_endpoints"),
        total("planned_requests"),
        *(total(c) for c in REQUEST_COUNTERS),
        total("watermark_skips"),
    )


def failure_alerts(failures: DataFrame, known_secrets: Iterable[str] = ()) -> DataFrame:
    """Alert rows of failed jobs (``run_id, job, task, logical_date, message``), safe to send on."""
    message = F.coalesce(F.col("message"), F.lit("unknown error"))
    safe = redact_secrets(message, known_secrets)
    return failures.select(
        F.lit(FAILURE_EVENT).alias("event"),
        "job",
        "task",
        "run_id",
        "logical_date",
        failure_reason(safe).alias("reason"),
        alert_text(message, known_secrets).alias("error"),
    )
