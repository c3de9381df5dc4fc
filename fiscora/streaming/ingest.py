"""Continuous ingest: every new landing file once, through the batch functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fiscora.catalog import Endpoint
from fiscora.functions import ingest_date
from fiscora.plans.ingest import LakePaths, ingest
from fiscora.sources.paths import exists
from fiscora.sources.state import is_fed

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)


def landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Documents from ``year=/month=/day=`` landing folders, one per line."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path)
    return lines.select(
        F.col("value").alias("raw_data"),
        ingest_date(F.col("year"), F.col("month"), F.col("day")).alias("ingest_date"),
    )


def start_ingest(
    spark: SparkSession,
    landing: str,
    endpoint: Endpoint,
    paths: LakePaths,
    checkpoint: str,
    *,
    max_files: int | None = None,
) -> StreamingQuery:
    """Process all files present and stop. A restart continues after the last batch.

    Each micro-batch writes under its own number and reads the state of the batch
    before it, so a batch that Spark replays after a failure gives the same result.
    The numbers are the stream's own: an endpoint is fed by one stream or by batches,
    and a new stream refuses one that already has state.
    """
    fresh = not exists(spark, f"{checkpoint}/offsets")
    if fresh and is_fed(spark, paths.state_of(endpoint)):
        raise ValueError(f"{endpoint.name} under {paths.state} is already fed by batches or another stream")

    def process(batch: DataFrame, batch_id: int) -> None:
        ingest(spark, batch, endpoint, paths, run_id=f"stream-{batch_id}", batch=batch_id)

    return (
        landing_stream(spark, landing, max_files)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
