"""Deterministic batches of keys and their rotation over business days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscora.functions import days_since_monday, weekday
from fiscora.session import ensure_checkpoint_dir

DAYS_PER_WEEK = 7


def with_ordinal(keys: DataFrame, order: str, name: str = "ordinal") -> DataFrame:
    """Number keys 1..n by ``order``, one row per key, without gathering them in one task.

    Keys are range-partitioned and sorted; each partition numbers its own rows and
    adds the count of the partitions before it. The partition number is fixed by a
    reliable checkpoint first, so a lost executor cannot change it between uses.
    """
    ensure_checkpoint_dir(keys.sparkSession)
    ranged = (
        keys.repartitionByRange(F.col(order).asc_nulls_first())
        .withColumn("_part", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    # one row per partition
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_first()))
    return (
        ranged.join(offsets, "_part")
        .withColumn(name, (F.col("_offset") + within).cast("bigint"))
        .drop("_part", "_offset")
    )


def batch_id(ordinal: Column, size: int) -> Column:
    """Zero-based batch of a one-based ordinal."""
    return F.floor((ordinal - 1).cast("decimal(20,0)") / F.lit(size).cast("decimal(10,0)")).cast("bigint")


def with_batches(keys: DataFrame, size: int, ordinal: str) -> DataFrame:
    return keys.withColumn("batch_id", batch_id(F.col(ordinal), size))


def batch_for_index(day_index: Column, n_batches: Column) -> Column:
    """Batch served on the given day of a cycle; wraps after the last one."""
    return F.pmod(day_index, n_batches)


def batch_of_day(batches: DataFrame, days: DataFrame) -> DataFrame:
    """``run_date, day_index, batch_id``: the business date picks the batch.

    Up to seven batches go by weekday. More than seven would never all have their turn
    that way, so days are then counted from a fixed Monday; for seven both rules agree.
    """
    n_batches = batches.agg(F.max("batch_id") + 1).scalar()
    day = F.col("run_date")
    index = F.when(n_batches <= DAYS_PER_WEEK, weekday(day)).otherwise(days_since_monday(day))
    return days.select("run_date", index.alias("day_index")).withColumn(
        "batch_id", batch_for_index(F.col("day_index"), n_batches)
    )


def keys_of_day(batches: DataFrame, days: DataFrame) -> DataFrame:
    """The keys served on each business date. The same date always gives the same keys."""
    return batch_of_day(batches, days).join(batches, "batch_id")


def daily_plan(batches: DataFrame, days: DataFrame, endpoints: int, daily_limit: int) -> DataFrame:
    """Planned work per business date: ``run_date, day_index, batch_id, keys, planned_requests, within_limit``.

    Batches are counted first, so the join has one row per batch on one side and one
    per day on the other.
    """
    per_batch = batches.groupBy("batch_id").agg(F.count(F.lit(1)).alias("keys"))
    requests = F.col("keys") * endpoints
    return batch_of_day(batches, days).join(per_batch, "batch_id").select(
        "run_date",
        "day_index",
        "batch_id",
        "keys",
        requests.alias("planned_requests"),
        (requests <= daily_limit).alias("within_limit"),
    )


def planned_load(planned: DataFrame, daily_limit: int) -> DataFrame:
    """Source calls of each run of a plan ``(run_id, endpoint, symbol)``: ``run_date`` names the run."""
    load = planned.groupBy(F.col("run_id").alias("run_date")).agg(F.count(F.lit(1)).alias("planned_requests"))
    return load.withColumn("within_limit", F.col("planned_requests") <= daily_limit)


def planned_keys(batches: DataFrame, days: DataFrame, key: str, endpoints: Sequence[str]) -> DataFrame:
    """The plan of each business date: ``run_id`` (the date), ``endpoint``, ``symbol``."""
    names = F.explode(F.array(*(F.lit(e) for e in endpoints)))
    return keys_of_day(batches, days).select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_id"), names.alias("endpoint"), F.col(key).cast("string").alias("symbol")
    )


def require_within_limit(plan: DataFrame) -> None:
    """Raise if any planned day needs more source calls than it may make."""
    worst = plan.where(~F.col("within_limit")).orderBy(F.col("planned_requests").desc(), "run_date").first()
    if worst is not None:
        raise ValueError(f"{worst['run_date']} needs {worst['planned_requests']} requests, above the daily limit")


def cycle_days(batches: DataFrame, first_day: Column) -> DataFrame:
    """``run_date`` of the consecutive days in which every batch has its turn: a week, or a day per batch."""
    n_batches = F.max("batch_id") + 1
    last_day = F.date_add(first_day, (F.greatest(n_batches, F.lit(DAYS_PER_WEEK)) - 1).cast("int"))
    return batches.agg(F.sequence(first_day, last_day).alias("days")).select(F.explode("days").alias("run_date"))


def coverage(batches: DataFrame, key: str, first_day: Column) -> DataFrame:
    """How often the keys are served in one cycle from ``first_day``, counted from the days' own keys.

    ``n_keys, n_never, n_more_than_once, n_served``. With seven batches or more every key should be
    served once; with fewer, some batches have two turns a week.
    """
    served = keys_of_day(batches, cycle_days(batches, first_day)).groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    times = F.coalesce("times", F.lit(0))
    return batches.select(key).distinct().join(served, key, "left").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(times == 0).alias("n_never"),
        F.count_if(times > 1).alias("n_more_than_once"),
        F.coalesce(F.sum(times), F.lit(0)).cast("bigint").alias("n_served"),
    )
