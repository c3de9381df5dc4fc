"""What the corpus operators share: columns by place, work tables, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.session import shared_dir
from fiscora.sources.paths import hadoop_path

# Spark drops the shuffle files of a finished job at once instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def narrow(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by place.

    Other columns may repeat a name, differ from one in case only, or hold dots:
    they are given neutral names first and never resolved.
    """
    places = [frame.columns.index(name) for name in names]
    plain = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in zip(places, names, strict=True)])


def by_place(frame: DataFrame) -> tuple[DataFrame, list[str], dict[str, Column]]:
    """All columns under neutral names, the true names, and the column that each true name first stands for."""
    names = frame.columns
    plain = frame.toDF(*[f"c{i}" for i in range(len(names))])
    return plain, names, {name: F.col(f"c{i}") for i, name in reversed(list(enumerate(names)))}


def text_key(text: Column | str, seed: int = 0) -> Column:
    """64 bits of a text; with two seeds 128 bits. NULL counts as the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(text, F.lit("")), F.lit(seed))


class Workspace:
    """Tables of one run, written as Parquet in the folder that all executors share.

    A written table cuts the lineage: a lost executor costs the tasks of one step,
    not the steps before it. ``drop`` frees a table that no later step reads; what the
    result still reads stays in the folder, for its owner to clear.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"

    def put(self, frame: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            writer = frame.write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(partition_by)
            writer.parquet(f"{self.base}/{name}")
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)
        return self.read(name, frame)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            target, fs = hadoop_path(self.spark, f"{self.base}/{name}")
            fs.delete(target, True)


def partitions(rows: int, per_partition: int, least: int = 1) -> int:
    """How many partitions hold ``rows`` at ``per_partition`` each."""
    return max(least, -(-int(rows) // per_partition))
