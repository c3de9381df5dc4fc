"""Batch, run and attempt summaries, and key batching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.catalog import BALANCE, EARNINGS, ENDPOINTS, INCOME
from fiscora.functions import business_date
from fiscora.operators import audit, batching, contract
from fiscora.plans.ingest import processed_keys
from fiscora.queries.expected import DOCUMENTS, SYMBOL, query, reason_of, route_of
from fiscora.queries.lake import scratch, staged
from fiscora.queries.payloads import event_attempts, table
from fiscora.queries.registry import registered
from fiscora.sources.audit_log import read_attempts, write_attempts

RUN = "run-7"
# Keys per batch, source calls allowed per day, endpoints per key.
BATCH_SIZE, DAILY_LIMIT, CALLS_PER_KEY = 5, 25, 5
FAULTY = (INCOME.name, BALANCE.name)


def planned_keys(spark, sf_dir) -> DataFrame:
    """Every company, for every endpoint."""
    names = F.explode(F.array(*(F.lit(e) for e in ENDPOINTS)))
    return table(spark, sf_dir, "supplier").select(
        F.lit(RUN).alias("run_id"),
        names.alias("endpoint"),
        F.concat(F.lit("SUP"), F.col("s_suppkey").cast("string")).alias("symbol"),
    )


def processed_documents(spark, sf_dir) -> DataFrame:
    """Stored verdicts on the documents of all days. Two endpoints carry faults, and overviews
    and cash flows are not there for all keys."""
    frames = [staged(spark, sf_dir, e, faults=e.name in FAULTY).drop("raw_data") for e in ENDPOINTS.values()]
    routed = reduce(DataFrame.unionByName, frames)
    # earnings documents of even keys hold no newer period
    known = (F.col("endpoint") == EARNINGS.name) & (F.col("k") % 2 == 0)
    asked = F.concat(F.lit("SUP"), F.col("k").cast("string"))  # an error answer names no company
    return routed.withColumn("symbol", asked).withColumn(
        "route", F.when(known, contract.NO_CHANGE).otherwise(F.col("route"))
    ).transform(lambda d: processed_keys(d, RUN))


_OUTCOMES = f"""processed AS (
  SELECT DISTINCT endpoint, k,
    CASE WHEN endpoint = 'earnings' AND k % 2 = 0 THEN 'no_change'
      WHEN endpoint IN ('income_statement', 'balance_sheet') THEN {route_of("income_statement")}
      ELSE 'accepted' END AS route,
    endpoint IN ('income_statement', 'balance_sheet') AND k % 20 IN (5, 6) AS stopped,
    CASE endpoint WHEN 'income_statement' THEN {reason_of(INCOME)} WHEN 'balance_sheet' THEN {reason_of(BALANCE)} END AS reason
  FROM documents),
planned AS (
  SELECT s_suppkey AS k,
    unnest(['overview', 'income_statement', 'balance_sheet', 'cash_flow', 'earnings']) AS endpoint
  FROM supplier),
outcomes AS (
  SELECT p.endpoint, p.k, coalesce(r.route IN ('accepted', 'no_change'), FALSE) AS completed,
    coalesce(r.route = 'no_change', FALSE) AS no_change,
    coalesce(r.route IN ('rejected', 'quarantine'), FALSE) AS failed, r.route IS NULL AS pending,
    coalesce(r.stopped, FALSE) AS stopped, CASE WHEN r.route IN ('rejected', 'quarantine') THEN r.reason END AS reason
  FROM planned p LEFT JOIN processed r USING (endpoint, k)),
summaries AS (
  SELECT endpoint, count(*) AS planned_requests, count(*) FILTER (completed) AS completed,
    count(*) FILTER (no_change) AS watermark_skips, count(*) FILTER (failed) AS failed, count(*) FILTER (pending) AS pending,
    bool_or(stopped) AS stopped_early,
    CASE WHEN NOT bool_or(failed) AND NOT bool_or(pending) THEN 'SUCCESS'
      WHEN bool_or(stopped) THEN 'ERROR' ELSE 'PARTIAL_SUCCESS' END AS status
  FROM outcomes GROUP BY endpoint)"""


def _summary(spark, sf_dir) -> DataFrame:
    outcomes = audit.batch_outcomes(planned_keys(spark, sf_dir), processed_documents(spark, sf_dir))
    return audit.batch_summary(outcomes)


@registered(
    "batch_outcomes",
    query(
        f"""SELECT '{RUN}' AS run_id, endpoint, {SYMBOL} AS symbol, 1 AS planned,
              CAST(completed AS INTEGER) AS completed, CAST(no_change AS INTEGER) AS no_change,
              CAST(failed AS INTEGER) AS failed, CAST(stopped AS INTEGER) AS stopped,
              CAST(pending AS INTEGER) AS pending, reason FROM outcomes""",
        DOCUMENTS,
        _OUTCOMES,
    ),
)
def batch_outcomes(spark, sf_dir):
    return audit.batch_outcomes(planned_keys(spark, sf_dir), processed_documents(spark, sf_dir))


@registered(
    "pending_keys",
    query(
        f"SELECT '{RUN}' AS run_id, endpoint, {SYMBOL} AS symbol FROM outcomes WHERE pending", DOCUMENTS, _OUTCOMES
    ),
)
def pending_keys(spark, sf_dir):
    return audit.pending_keys(planned_keys(spark, sf_dir), processed_documents(spark, sf_dir))


@registered(
    "batch_summary",
    query(f"SELECT '{RUN}' AS run_id, * FROM summaries", DOCUMENTS, _OUTCOMES),
)
def batch_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def _attempts_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(ENDPOINTS))
    return f"""attempts AS (
      SELECT strftime(ts, '%Y-%m-%d') AS run_id, CASE user_id % {len(ENDPOINTS)} {cases} END AS endpoint,
        event_id % 3 + 1 AS attempt,
        CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 10 = 3 THEN 'rate_limit_daily'
          WHEN event_id % 10 = 6 THEN 'rate_limit_transient' ELSE 'success' END AS status
      FROM events)"""


_COUNTERS = """count(*) AS actual_requests, count(*) FILTER (status = 'success') AS successful_requests,
  count(*) FILTER (status = 'failed') AS failed_requests, count(*) FILTER (status LIKE 'rate_limit%') AS rate_limit_requests,
  count(*) FILTER (attempt > 1) AS retry_requests"""


@registered(
    "attempt_metrics",
    f"WITH {_attempts_sql()} SELECT run_id, endpoint, {_COUNTERS} FROM attempts GROUP BY run_id, endpoint",
)
def attempt_metrics(spark, sf_dir):
    """Source calls through the attempt log: written, read back with its schema, and counted."""
    path = scratch(spark, sf_dir, "attempts")
    write_attempts(event_attempts(spark, sf_dir, list(ENDPOINTS)), path, mode="overwrite")
    return audit.attempt_metrics(read_attempts(spark, path))


@registered(
    "run_summary",
    query(
        f"""SELECT '{RUN}' AS run_id, CASE WHEN bool_or(s.status <> 'SUCCESS') THEN 'PARTIAL_SUCCESS'
              ELSE 'SUCCESS' END AS status, count(*) AS endpoints,
              count(*) FILTER (s.status = 'PARTIAL_SUCCESS') AS partial_endpoints,
              count(*) FILTER (s.status = 'ERROR') AS failed_endpoints,
              CAST(sum(planned_requests) AS BIGINT) AS planned_requests,
              CAST(sum(actual_requests) AS BIGINT) AS actual_requests,
              CAST(sum(successful_requests) AS BIGINT) AS successful_requests,
              CAST(sum(failed_requests) AS BIGINT) AS failed_requests,
              CAST(sum(rate_limit_requests) AS BIGINT) AS rate_limit_requests,
              CAST(sum(retry_requests) AS BIGINT) AS retry_requests,
              CAST(sum(watermark_skips) AS BIGINT) AS watermark_skips
            FROM summaries s LEFT JOIN (SELECT endpoint, {_COUNTERS} FROM attempts GROUP BY endpoint) m USING (endpoint)""",
        DOCUMENTS,
        _OUTCOMES,
        _attempts_sql(),
    ),
)
def run_summary(spark, sf_dir):
    attempts = event_attempts(spark, sf_dir, list(ENDPOINTS)).withColumn("run_id", F.lit(RUN))
    return audit.run_summary(_summary(spark, sf_dir), audit.attempt_metrics(attempts))


@registered(
    "key_batches",
    f"""SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS ordinal,
          (row_number() OVER (ORDER BY c_custkey) - 1) // {BATCH_SIZE} AS batch_id FROM customer""",
)
def key_batches(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    return batching.with_batches(batching.with_ordinal(keys, "c_custkey"), BATCH_SIZE, "ordinal")


_SUPPLIER_BATCHES = f"""batches AS (SELECT s_suppkey, s_suppkey // {BATCH_SIZE} AS batch_id FROM supplier)"""


def _supplier_batches(spark, sf_dir) -> DataFrame:
    """Suppliers carry a stored ordinal: their key, counted from zero."""
    keys = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") + 1).alias("ordinal"))
    return batching.with_batches(keys, BATCH_SIZE, "ordinal")


_DAYS = """days AS (
  SELECT DISTINCT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE) AS run_date FROM events)"""
_N_BATCHES = "(SELECT max(batch_id) + 1 FROM batches)"
_DAY_INDEX = f"""CASE WHEN {_N_BATCHES} <= 7 THEN isodow(run_date) - 1
  ELSE datediff('day', DATE '1970-01-05', run_date) END"""
_BATCH_OF_DAY = f"({_DAY_INDEX}) % {_N_BATCHES}"


def _business_days(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(business_date(F.col("ts")).alias("run_date")).distinct()


@registered(
    "business_batches",
    f"""WITH {_SUPPLIER_BATCHES}, {_DAYS}
        SELECT run_date, CAST({_DAY_INDEX} AS INTEGER) AS day_index, batch_id, keys,
          keys * {CALLS_PER_KEY} AS planned_requests, keys * {CALLS_PER_KEY} <= {DAILY_LIMIT} AS within_limit
        FROM days JOIN (SELECT batch_id, count(*) AS keys FROM batches GROUP BY batch_id) b
          ON b.batch_id = {_BATCH_OF_DAY}""",
)
def business_batches(spark, sf_dir):
    days = _business_days(spark, sf_dir)
    return batching.daily_plan(_supplier_batches(spark, sf_dir), days, CALLS_PER_KEY, DAILY_LIMIT)


@registered(
    "business_batch_keys",
    f"""WITH {_SUPPLIER_BATCHES}, {_DAYS}
        SELECT run_date, batch_id, s_suppkey FROM days JOIN batches ON batch_id = {_BATCH_OF_DAY}""",
)
def business_batch_keys(spark, sf_dir):
    keys = batching.keys_of_day(_supplier_batches(spark, sf_dir), _business_days(spark, sf_dir))
    return keys.select("run_date", "batch_id", "s_suppkey")


# a day per batch, a week at least; who is served is counted from the days
_CYCLE = f"""cycle AS (SELECT DATE '2026-09-07' + CAST(i AS INTEGER) AS run_date FROM
    (SELECT unnest(range(greatest({_N_BATCHES}, 7))) AS i)),
served AS (SELECT key, count(*) AS times FROM cycle JOIN batches ON batch_id = {_BATCH_OF_DAY} GROUP BY key)"""
_COVERAGE = """SELECT count(*) AS n_keys, count(*) FILTER (times IS NULL) AS n_never,
    count(*) FILTER (times > 1) AS n_more_than_once, CAST(sum(coalesce(times, 0)) AS BIGINT) AS n_served
  FROM (SELECT DISTINCT key FROM batches) LEFT JOIN served USING (key)"""


def _monday() -> Column:
    return F.to_date(F.lit("2026-09-07"))


def _batch_sql(batches: str) -> str:
    return f"WITH batches AS ({batches}), {_CYCLE} {_COVERAGE}"


@registered("cycle_coverage", _batch_sql(f"SELECT s_suppkey AS key, s_suppkey // {BATCH_SIZE} AS batch_id FROM supplier"))
def cycle_coverage(spark, sf_dir):
    return batching.coverage(_supplier_batches(spark, sf_dir), "s_suppkey", _monday())


@registered(
    "customer_coverage",
    _batch_sql(
        f"SELECT c_custkey AS key, (row_number() OVER (ORDER BY c_custkey) - 1) // {BATCH_SIZE} AS batch_id FROM customer"
    ),
)
def customer_coverage(spark, sf_dir):
    """Far more than seven batches: the cycle is as long as they need, and all keys have their turn."""
    return batching.coverage(key_batches(spark, sf_dir), "c_custkey", _monday())


@registered(
    "cycle_coverage_planted",
    _batch_sql(
        f"""SELECT s_suppkey AS key, s_suppkey // {BATCH_SIZE} AS batch_id FROM supplier WHERE s_suppkey % 10 <> 3
            UNION ALL SELECT s_suppkey, 1 + s_suppkey // {BATCH_SIZE} FROM supplier WHERE s_suppkey % 10 = 4
            UNION ALL SELECT s_suppkey, -1 FROM supplier WHERE s_suppkey % 10 = 3"""
    ),
)
def cycle_coverage_planted(spark, sf_dir):
    """Keys in two batches are found as served too often, keys in no valid batch as never served."""
    batches = _supplier_batches(spark, sf_dir)
    kind = F.col("s_suppkey") % 10
    twice = batches.where(kind == 4).withColumn("batch_id", F.col("batch_id") + 1)
    lost = batches.where(kind == 3).withColumn("batch_id", F.lit(-1).cast("bigint"))
    return batching.coverage(batches.where(kind != 3).unionByName(twice).unionByName(lost), "s_suppkey", _monday())


@registered(
    "planned_runs",
    f"""WITH batches AS (SELECT s_suppkey AS key, s_suppkey // {BATCH_SIZE} AS batch_id FROM supplier), {_DAYS},
        plan AS (SELECT run_date, count(*) * {CALLS_PER_KEY} AS calls FROM days JOIN batches ON batch_id = {_BATCH_OF_DAY}
          GROUP BY run_date)
        SELECT strftime(run_date, '%Y-%m-%d') AS run_date, calls AS planned_requests, calls <= {DAILY_LIMIT} AS within_limit
        FROM plan""",
)
def planned_runs(spark, sf_dir):
    """Each business date's plan over all endpoints, held against the daily limit."""
    days = _business_days(spark, sf_dir)
    plan = batching.planned_keys(_supplier_batches(spark, sf_dir), days, "s_suppkey", list(ENDPOINTS))
    load = batching.planned_load(plan, DAILY_LIMIT)
    batching.require_within_limit(load)
    return load
