"""A whole run: ingest every endpoint, summarise, gate Silver, rebuild and gate Gold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS
from fiscora.operators import audit, batching, quality
from fiscora.plans.gold import MART_COLUMNS, SilverFrames, build_gold
from fiscora.plans.ingest import LakePaths, ingest, processed_keys
from fiscora.sources import latest_rows
from fiscora.sources.audit_log import BATCH_EVENT, SUMMARY_SCHEMA, read_batch_summaries, write_log
from fiscora.sources.gold_table import read_gold, write_gold

# Jobs run side by side, and the name of the mart in test reports.
CONCURRENT_ENDPOINTS = 4
GOLD_MODEL = "fundamental_kpis"


class BatchError(RuntimeError):
    """An endpoint did not complete its batch in strict mode."""


@dataclass(frozen=True)
class RunResult:
    summaries: DataFrame
    silver_report: DataFrame
    gold_report: DataFrame
    gold: DataFrame


def latest_frames(spark: SparkSession, paths: LakePaths, buckets: int = latest_rows.BUCKETS) -> SilverFrames:
    """Stored latest rows of every endpoint; only batches that are new since the last run are parsed and shuffled."""

    def refreshed(name: str) -> tuple[DataFrame, bool]:
        return latest_rows.refresh(
            spark, paths.bronze, paths.periods, paths.latest, ENDPOINTS[name], MART_COLUMNS[name], buckets
        )

    with ThreadPoolExecutor(CONCURRENT_ENDPOINTS) as pool:
        found = dict(zip(ENDPOINTS, pool.map(refreshed, ENDPOINTS), strict=True))
    in_buckets = all(lies_in_buckets for _, lies_in_buckets in found.values())
    return SilverFrames.of({name: rows for name, (rows, _) in found.items()}, by_company=in_buckets)


def summarise(
    planned: DataFrame, processed: DataFrame, path: str, *, allow_partial: bool = True
) -> DataFrame:
    """Write one summary row per endpoint to the audit log and return the rows."""
    summary = audit.batch_summary(audit.batch_outcomes(planned, processed), allow_partial=allow_partial)
    rows = summary.withColumns(
        {
            "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
            "event": F.lit(BATCH_EVENT),
        }
    ).select(*SUMMARY_SCHEMA.names)
    write_log(rows, path, mode="overwrite")
    return read_batch_summaries(planned.sparkSession, path)


def silver_report(models: dict[str, DataFrame]) -> DataFrame:
    """Tests of Silver models. They read the key columns only."""
    return quality.layer_report(models, quality.SILVER_TESTS)


def gold_report(gold: DataFrame) -> DataFrame:
    return quality.layer_report({GOLD_MODEL: gold}, quality.GOLD_TESTS)


def run(
    spark: SparkSession,
    landing: dict[str, DataFrame],
    paths: LakePaths,
    run_id: str,
    *,
    planned: DataFrame | None = None,
    daily_limit: int | None = None,
    allow_partial: bool = True,
) -> RunResult:
    """Ingest documents per endpoint, then rebuild Gold from the latest typed rows of all of Bronze.

    ``planned`` lists the ``(run_id, endpoint, symbol)`` asked for; without it, what
    arrived counts as the plan. A plan of more than ``daily_limit`` source calls is refused before
    anything is ingested. In best-effort mode failed documents are recorded
    and the rebuild uses the Bronze at hand. Gold waits for the Silver gate; its own
    gate is checked on the stored table.
    """
    if planned is not None and daily_limit is not None:
        batching.require_within_limit(batching.planned_load(planned, daily_limit))
    # endpoints are independent: a few side by side keep the executors busy
    with ThreadPoolExecutor(CONCURRENT_ENDPOINTS) as pool:
        decisions = pool.map(lambda item: ingest(spark, item[1], item[0], paths, run_id), landing.items())
        processed = reduce(DataFrame.unionByName, [processed_keys(d, run_id) for d in decisions])
    if planned is None:
        planned = processed.where(F.col("symbol").isNotNull()).select("run_id", "endpoint", "symbol").distinct()
    summaries = summarise(planned, processed, f"{paths.audit}/runs/run_id={run_id}", allow_partial=allow_partial)
    if not allow_partial:
        # one row per endpoint
        broken = [r["endpoint"] for r in summaries.where(F.col("status") != audit.SUCCESS).collect()]
        if broken:
            raise BatchError(f"incomplete batches: {', '.join(sorted(broken))}")

    # the gate and the mart both read the stored rows, deduplicated once
    frames = latest_frames(spark, paths)
    silver_tests = silver_report(frames.by_endpoint())
    quality.require(silver_tests, "silver")
    write_gold(build_gold(frames), paths.gold)
    gold = read_gold(spark, paths.gold)
    gold_tests = gold_report(gold)
    quality.require(gold_tests, "gold")
    return RunResult(summaries, silver_tests, gold_tests, gold)
