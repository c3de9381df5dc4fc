"""Batch ingest: check, route, compare with the watermark, store, then advance the state."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, Endpoint
from fiscora.functions import redact_api_keys
from fiscora.operators import contract, watermark
from fiscora.operators.contract import ACCEPTED, NO_CHANGE, QUARANTINE
from fiscora.sources import latest_rows, periods
from fiscora.sources.audit_log import TICKER_EVENT, write_log
from fiscora.sources.bronze import (
    begin_batch,
    endpoint_path,
    finish_batch,
    quarantine_path,
    write_bronze,
    write_quarantine,
    write_texts,
)
from fiscora.sources.paths import delete
from fiscora.sources.state import next_number, read_state, write_increment

# Numbers of accepted documents that are broadcast: some 40 MB at most.
BROADCAST_NUMBERS = 1_000_000

_AUDIT_STATUS = {ACCEPTED: "SUCCESS", QUARANTINE: "QUARANTINE"}


@dataclass(frozen=True)
class LakePaths:
    """Where one lake keeps its parts."""

    bronze: str
    periods: str
    latest: str
    staged: str
    state: str
    audit: str
    decisions: str
    gold: str

    @classmethod
    def under(cls, root: str) -> LakePaths:
        root = root.rstrip("/")
        return cls(**{part.name: f"{root}/{part.name}" for part in fields(cls)})

    def state_of(self, endpoint: Endpoint) -> str:
        return f"{self.state}/{endpoint.name}"


def settle(routed: DataFrame, state: DataFrame) -> DataFrame:
    """Final route of checked documents: one without a newer period becomes no_change.

    Only documents that pass the contract are compared with, and raise, the watermark.
    Rows are shuffled, so they should be stored ones without the text.
    """
    accepted = F.col("route") == ACCEPTED
    candidates = routed.withColumns(
        {"_date": F.col("fiscal_date"), "fiscal_date": F.when(accepted, F.col("fiscal_date"))}
    )
    marked = watermark.mark_new(candidates, state)
    final = F.when(accepted & ~F.col("is_new"), NO_CHANGE).otherwise(F.col("route"))
    return marked.withColumns({"route": final, "fiscal_date": F.col("_date")}).drop("_date", "is_new")


def stage(payloads: DataFrame, endpoint: Endpoint, path: str, probe_rule: str = "first") -> DataFrame:
    """Check documents (``raw_data``, ``ingest_date``) against the contract, number them and store them.

    The one parse of a batch: whatever follows reads columns of the stored rows.
    """
    routed = contract.route(payloads, endpoint, probe_rule)
    write_texts(watermark.with_document_id(routed), path)
    return payloads.sparkSession.read.parquet(path)


def decide(staged: DataFrame, state: DataFrame) -> DataFrame:
    """Settle stored documents, without their text."""
    return settle(staged.drop("raw_data"), state)


def _is_broadcast(numbers: DataFrame) -> bool:
    """Are there few enough numbers, in a session that broadcasts at all? Counts stored rows."""
    if numbers.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    return numbers.limit(BROADCAST_NUMBERS + 1).count() <= BROADCAST_NUMBERS


def accepted_documents(staged: DataFrame, decisions: DataFrame, endpoint: Endpoint) -> DataFrame:
    """Documents as Bronze stores them: whole amounts plain, extraction date added.

    Texts meet the stored decisions by document number. Up to a million numbers are broadcast and no text
    moves. With more, or where the session broadcasts nothing, Spark's runtime filter on the numbers keeps
    skipped texts out of the shuffle, and those that move are matched in a hash table of the numbers, not sorted.
    """
    new = decisions.where(F.col("route") == ACCEPTED).select(watermark.DOCUMENT)
    new = new.hint("broadcast" if _is_broadcast(new) else "shuffle_hash")
    plain = contract.plain_integers(F.col("raw_data"), endpoint)
    stamped = contract.stamp_extraction_date(plain, F.col("ingest_date"))
    passed = staged.where(F.col("route") == ACCEPTED)
    return passed.join(new, watermark.DOCUMENT, "left_semi").withColumn("raw_data", stamped)


def ticker_events(decisions: DataFrame, run_id: str, location: str) -> DataFrame:
    """One audit row per stored, quarantined or failed document. A skipped one has none."""
    status = F.lit("ERROR")
    for route, name in _AUDIT_STATUS.items():
        status = F.when(F.col("route") == route, name).otherwise(status)
    return decisions.where(F.col("route") != NO_CHANGE).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        F.lit(TICKER_EVENT).alias("event"),
        F.lit(run_id).alias("run_id"),
        status.alias("status"),
        F.lit(location).alias("stage_location_bucket"),
        F.date_format("ingest_date", "yyyy-MM-dd").alias("last_updated"),
        F.upper("endpoint").alias("endpoint"),
        "symbol",
        F.col("n_records").alias("rows_processed"),
        F.round(F.col("n_bytes") / (1024 * 1024), 6).alias("size_mb"),
        # documents of a batch are not handled one after the other
        F.lit(None).cast("double").alias("time_seconds"),
        F.when(F.col("reason").isNotNull(), redact_api_keys(F.col("reason"))).alias("error_message"),
    )


def ingest(
    spark: SparkSession,
    payloads: DataFrame,
    endpoint: Endpoint | str,
    paths: LakePaths,
    run_id: str,
    *,
    batch: int | None = None,
    probe_rule: str = "first",
) -> DataFrame:
    """Ingest one batch of documents of one endpoint and return its stored decisions.

    Every batch has a number (the one after the last finished batch unless given) and
    writes only to folders of that number, each replaced whole, from the state before
    it. Running a number again therefore replaces its output, whatever documents it had the
    first time. Readers of Bronze see a batch once it is wholly written, see
    ``bronze.finish_batch``. The state's increment is written last: a run that dies before it is
    repeated under the same number, and neither loses nor leaves anything.

    Documents are parsed once and stored with their verdicts in the lake. The text is
    read from there only to store accepted and quarantined documents; decisions, state
    and audit rows use the narrow columns.
    """
    endpoint = ENDPOINTS[endpoint] if isinstance(endpoint, str) else endpoint
    state_dir = paths.state_of(endpoint)
    number = next_number(spark, state_dir) if batch is None else batch
    state = read_state(spark, state_dir, before=number)
    staged_dir = f"{paths.staged}/{endpoint.name}/batch={number}"
    decisions_dir = f"{paths.decisions}/{endpoint.name}/batch={number}"
    stores = [endpoint_path(paths.bronze, endpoint.name), quarantine_path(paths.bronze, endpoint.name)]
    for store in stores:
        begin_batch(spark, store, number)
    latest_rows.forget(spark, paths.latest, endpoint, number)
    periods.forget(spark, paths.periods, endpoint, number)
    staged = stage(payloads, endpoint, staged_dir, probe_rule)
    decide(staged, state).write.mode("overwrite").parquet(decisions_dir)
    decisions = spark.read.parquet(decisions_dir)
    write_bronze(
        accepted_documents(staged, decisions, endpoint), endpoint_path(paths.bronze, endpoint.name), batch=number
    )
    write_quarantine(staged.where(F.col("route") == QUARANTINE), paths.bronze, endpoint.name, batch=number)
    events = ticker_events(decisions, run_id, paths.bronze)
    write_log(events, f"{paths.audit}/{endpoint.name}/batch={number}", mode="overwrite")
    # shown before the increment: a batch that dies in between is run again, and hidden first
    for store in stores:
        finish_batch(spark, store, number)
    write_increment(watermark.raised(state, decisions.where(F.col("route") == ACCEPTED)), state_dir, number)
    delete(spark, staged_dir)
    return decisions


def processed_keys(decisions: DataFrame, run_id: str) -> DataFrame:
    """Decisions in the form the batch summary reads."""
    return decisions.select(F.lit(run_id).alias("run_id"), "endpoint", "symbol", "route", "payload_class", "reason")
