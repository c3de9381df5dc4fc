"""Audit log: one JSON object per line, appended by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICKER_EVENT = "ticker_extraction"
BATCH_EVENT = "batch_summary"

TICKER_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("stage_location_bucket", T.StringType()),
        T.StructField("last_updated", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("size_mb", T.DoubleType()),
        T.StructField("time_seconds", T.DoubleType()),
        T.StructField("error_message", T.StringType()),
    ]
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("planned_requests", T.LongType()),
        T.StructField("completed", T.LongType()),
        T.StructField("watermark_skips", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("pending", T.LongType()),
        T.StructField("stopped_early", T.BooleanType()),
    ]
)
ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("finished_at", T.StringType()),
        T.StructField("error_type", T.StringType()),
    ]
)


def write_log(rows: DataFrame, path: str, *, mode: str = "append") -> None:
    rows.write.mode(mode).json(path)


def read_ticker_events(spark: SparkSession, path: str) -> DataFrame:
    """Per-document events. The schema is fixed, so nothing is scanned to infer it."""
    log = spark.read.schema(TICKER_SCHEMA).json(path)
    return log.where(log["event"] == TICKER_EVENT)


def write_attempts(attempts: DataFrame, path: str, *, mode: str = "append") -> None:
    """Log source calls, one per line. Columns that the caller does not know stay NULL."""
    columns = [
        (F.col(f.name) if f.name in attempts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ATTEMPT_SCHEMA.fields
    ]
    write_log(attempts.select(*columns), path, mode=mode)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ATTEMPT_SCHEMA).json(path)


def read_batch_summaries(spark: SparkSession, path: str) -> DataFrame:
    log = spark.read.schema(SUMMARY_SCHEMA).json(path)
    return log.where(log["event"] == BATCH_EVENT)
