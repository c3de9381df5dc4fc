"""Typed rows of the mart, kept per batch beside Bronze, so that a rebuild does not parse old JSON again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import Endpoint
from fiscora.plans import silver
from fiscora.sources.bronze import BATCH, BATCH_FOLDER, empty_staging, endpoint_path, finished_batches, read_batch, read_loose
from fiscora.sources.paths import child_names, delete, exists

def _batches(spark: SparkSession, path: str) -> list[int]:
    return [int(m.group(1)) for name in child_names(spark, path) if (m := BATCH_FOLDER.fullmatch(name))]


def known_batches(spark: SparkSession, bronze: str, endpoint: Endpoint) -> frozenset[int]:
    """Numbers of the finished batches that Bronze holds."""
    return finished_batches(spark, endpoint_path(bronze, endpoint.name))


def forget(spark: SparkSession, root: str, endpoint: Endpoint, batch: int) -> None:
    """Drop what was typed of a batch that is about to be replaced."""
    delete(spark, f"{root}/{endpoint.name}/{BATCH}={batch}")


def _empty(spark: SparkSession) -> DataFrame:
    return empty_staging(spark).withColumn(BATCH, F.lit(0).cast("bigint"))


def schema(spark: SparkSession, endpoint: Endpoint, columns: tuple[str, ...]) -> T.StructType:
    """Columns of the typed rows: those asked for, their keys and what orders their versions."""
    return silver.deliveries(_empty(spark), endpoint, columns).schema


def of_batches(
    spark: SparkSession, bronze: str, root: str, endpoint: Endpoint, columns: tuple[str, ...], batches: set[int] | frozenset[int]
) -> DataFrame:
    """Typed rows of numbered batches. Those not typed yet are parsed and stored first."""
    path, stored = endpoint_path(bronze, endpoint.name), f"{root}/{endpoint.name}"
    wanted = schema(spark, endpoint, columns)
    typed = set(_batches(spark, stored))
    for batch in sorted(batches):
        if batch not in typed or not exists(spark, f"{stored}/{BATCH}={batch}/_SUCCESS"):
            staging = read_batch(spark, path, batch)
            rows = silver.deliveries(_empty(spark) if staging is None else staging, endpoint, columns)
            rows.write.mode("overwrite").parquet(f"{stored}/{BATCH}={batch}")
    return spark.read.schema(wanted).parquet(*(f"{stored}/{BATCH}={n}" for n in sorted(batches)))


def loose(spark: SparkSession, bronze: str, endpoint: Endpoint, columns: tuple[str, ...]) -> DataFrame | None:
    """Typed rows of Bronze outside of numbered batches, parsed each time; None if all of it is numbered.

    Of copies of one day, one from a batch above 0 is the later delivery.
    """
    path = endpoint_path(bronze, endpoint.name)
    rows = read_loose(spark, path)
    if rows is None and finished_batches(spark, path):
        return None
    return silver.deliveries(empty_staging(spark) if rows is None else rows, endpoint, columns)
