from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fiscora.operators import audit, batching
from fiscora.sources import audit_log
from helpers import rows

PLANNED = "run_id string, endpoint string, symbol string"
ATTEMPTS = "run_id string, endpoint string, attempt int, status string"
PROCESSED = PLANNED + ", route string, payload_class string"


def summary(spark, planned, processed, **options):
    plan = spark.createDataFrame([("r", "overview", s) for s in planned], PLANNED)
    done = spark.createDataFrame([("r", "overview", *p) for p in processed], PROCESSED)
    return audit.batch_summary(audit.batch_outcomes(plan, done), **options).first().asDict()


@pytest.mark.parametrize(
    ("processed", "allow_partial", "status", "completed", "skips", "failed", "pending"),
    [
        ([("A", "accepted", "data"), ("B", "accepted", "data")], False, "SUCCESS", 2, 0, 0, 0),
        ([("A", "accepted", "data"), ("B", "rejected", "no_data")], False, "ERROR", 1, 0, 1, 0),
        ([("A", "accepted", "data"), ("B", "rejected", "no_data")], True, "PARTIAL_SUCCESS", 1, 0, 1, 0),
        ([("A", "no_change", "data"), ("B", "accepted", "data")], True, "SUCCESS", 2, 1, 0, 0),
        ([("A", "rejected", "daily_limit")], True, "ERROR", 0, 0, 1, 1),
        ([("A", "quarantine", "data")], True, "PARTIAL_SUCCESS", 0, 0, 1, 1),
    ],
)
def test_batch_summary(spark, processed, allow_partial, status, completed, skips, failed, pending):
    found = summary(spark, ["A", "B"], processed, allow_partial=allow_partial)
    names = ("status", "completed", "watermark_skips", "failed", "pending")
    assert tuple(found[n] for n in names) == (status, completed, skips, failed, pending)
    assert found["planned_requests"] == 2
    assert found["stopped_early"] == (status == "ERROR" and pending == 1)


def test_pending_keys(spark):
    plan = spark.createDataFrame([("r", "overview", s) for s in "ABC"], PLANNED)
    done = spark.createDataFrame([("r", "overview", "A", "accepted", "data")], PROCESSED)
    assert rows(audit.pending_keys(plan, done), "symbol") == [("B",), ("C",)]


def test_attempt_metrics(spark):
    data = [(1, "success"), (1, "rate_limit_daily"), (2, "rate_limit_transient"), (3, "failed"), (1, "other")]
    attempts = spark.createDataFrame([("r", "e", a, s) for a, s in data], ATTEMPTS)
    assert rows(audit.attempt_metrics(attempts), *audit.REQUEST_COUNTERS) == [(5, 1, 2, 2, 2)]


@pytest.mark.parametrize(
    ("statuses", "expected"),
    [
        (["SUCCESS", "SUCCESS"], "SUCCESS"),
        (["SUCCESS", "PARTIAL_SUCCESS"], "PARTIAL_SUCCESS"),
        (["SUCCESS", "ERROR"], "PARTIAL_SUCCESS"),
    ],
)
def test_run_summary(spark, statuses, expected):
    summaries = spark.createDataFrame(
        [("r", f"e{i}", s, 5, 1) for i, s in enumerate(statuses)],
        "run_id string, endpoint string, status string, planned_requests bigint, watermark_skips bigint",
    )
    attempts = spark.createDataFrame([("r", "e0", 1, "success")], ATTEMPTS)
    found = audit.run_summary(summaries, audit.attempt_metrics(attempts)).first()
    assert (found["status"], found["planned_requests"], found["watermark_skips"]) == (expected, 10, 2)
    assert found["actual_requests"] == 1


def test_audit_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    event = spark.createDataFrame(
        [("t", "ticker_extraction", "r", "SUCCESS", "b", "2026-02-17", "overview", "ORB", 1, 0.25, 0.5, None)],
        audit_log.TICKER_SCHEMA,
    )
    total = spark.createDataFrame(
        [("t", "batch_summary", "r", "overview", "SUCCESS", 1, 1, 0, 0, 0, False)], audit_log.SUMMARY_SCHEMA
    )
    audit_log.write_log(event, path)
    audit_log.write_log(total, path)
    assert rows(audit_log.read_ticker_events(spark, path), "symbol", "rows_processed") == [("ORB", 1)]
    assert rows(audit_log.read_batch_summaries(spark, path), "status", "planned_requests") == [("SUCCESS", 1)]


def test_batches_of_keys(spark):
    names = sorted(["oak", "elm", "fir", "ash", "yew", "box", "bay", "fig", "may"])
    keys = spark.createDataFrame([(k,) for k in reversed(names)], "k string")
    numbered = batching.with_batches(batching.with_ordinal(keys, "k"), 4, "ordinal")
    assert rows(numbered, "k", "ordinal", "batch_id") == [(k, i + 1, i // 4) for i, k in enumerate(names)]


def test_ordinals_over_many_partitions(spark):
    keys = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("k")).repartition(16)
    numbered = batching.with_ordinal(keys, "k")
    expected = sorted(i * 7919 % 20011 for i in range(20000))
    assert [r["k"] for r in numbered.orderBy("ordinal").collect()] == expected
    assert numbered.agg(F.max("ordinal"), F.countDistinct("ordinal")).first()[:] == (20000, 20000)


def test_plan_wraps_and_repeats(spark):
    keys = spark.range(35).select(F.col("id").alias("k"), (F.col("id") + 1).alias("ordinal"))
    batches = batching.with_batches(keys, 5, "ordinal")
    monday = date(2026, 9, 7)
    days = spark.createDataFrame([(monday + timedelta(days=i),) for i in range(8)], "run_date date")
    columns = ["run_date", "batch_id", "keys", "planned_requests", "within_limit"]
    plan = sorted(rows(batching.daily_plan(batches, days, 5, 25), *columns))
    assert [p[1] for p in plan] == [0, 1, 2, 3, 4, 5, 6, 0]
    assert all(p[2:] == (5, 25, True) for p in plan)
    found = batching.coverage(batches, "k", F.lit(monday)).first().asDict()
    assert found == {"n_keys": 35, "n_never": 0, "n_more_than_once": 0, "n_served": 35}


@pytest.mark.parametrize(("n_keys", "size", "cycle"), [(100, 5, 20), (40, 5, 8), (9, 3, 7), (1, 1, 7)])
def test_every_key_has_its_turn(spark, n_keys, size, cycle):
    """Served keys counted day by day, against the days themselves."""
    keys = spark.range(n_keys).select(F.col("id").alias("k"), (F.col("id") + 1).alias("ordinal"))
    batches = batching.with_batches(keys, size, "ordinal")
    first = date(2026, 9, 9)
    found_days = sorted(r["run_date"] for r in batching.cycle_days(batches, F.lit(first)).collect())
    assert found_days == [first + timedelta(days=i) for i in range(cycle)]
    days = spark.createDataFrame([(first + timedelta(days=i),) for i in range(cycle)], "run_date date")
    served = [r["k"] for r in batching.keys_of_day(batches, days).collect()]
    assert set(served) == set(range(n_keys))
    found = batching.coverage(batches, "k", F.lit(first)).first().asDict()
    assert found["n_never"] == 0 and found["n_served"] == len(served)
    if -(-n_keys // size) >= 7:
        assert len(served) == n_keys and found["n_more_than_once"] == 0


def test_coverage_finds_keys_served_twice_or_never(spark):
    batches = spark.createDataFrame([(k, k // 4) for k in range(40)] + [(3, 7), (99, -1)], "k bigint, batch_id bigint")
    found = batching.coverage(batches, "k", F.lit(date(2026, 9, 7))).first().asDict()
    assert found == {"n_keys": 41, "n_never": 1, "n_more_than_once": 1, "n_served": 41}


def test_reasons_of_failed_keys(spark):
    plan = spark.createDataFrame([("r", "overview", s) for s in "ABC"], PLANNED)
    done = [("r", "overview", "A", "accepted", "data", None), ("r", "overview", "B", "rejected", "no_data", "nothing in it")]
    outcomes = audit.batch_outcomes(plan, spark.createDataFrame(done, PROCESSED + ", reason string"))
    assert rows(outcomes, "symbol", "failed", "reason") == [("A", 0, None), ("B", 1, "nothing in it"), ("C", 0, None)]


def test_attempt_log_round_trip(spark, tmp_path):
    calls = spark.createDataFrame([("r9", "earnings", 2, "rate_limit_daily"), ("r9", "earnings", 1, "success")], ATTEMPTS)
    audit_log.write_attempts(calls, str(tmp_path / "calls"))
    read = audit_log.read_attempts(spark, str(tmp_path / "calls"))
    assert read.schema == audit_log.ATTEMPT_SCHEMA
    assert rows(audit.attempt_metrics(read), *audit.REQUEST_COUNTERS) == [(2, 1, 0, 1, 1)]


def test_batch_for_index_wraps_over_fewer_batches(spark):
    keys = spark.range(5).select(F.col("id").alias("k"), (F.col("id") + 1).alias("ordinal"))
    batches = batching.with_batches(keys, 2, "ordinal")
    wednesday = spark.createDataFrame([(date(2026, 9, 9),)], "run_date date")
    plan = batching.daily_plan(batches, wednesday, 5, 25)
    assert rows(plan, "batch_id", "keys") == [(2, 1)]


def test_plan_above_the_limit_is_flagged(spark):
    keys = spark.range(6).select(F.col("id").alias("k"), (F.col("id") + 1).alias("ordinal"))
    plan = batching.daily_plan(
        batching.with_batches(keys, 6, "ordinal"), spark.createDataFrame([(date(2026, 9, 7),)], "run_date date"), 5, 25
    )
    assert rows(plan, "planned_requests", "within_limit") == [(30, False)]
    with pytest.raises(ValueError, match="above the daily limit"):
        batching.require_within_limit(plan)


def test_keys_of_a_date_do_not_change(spark):
    keys = spark.range(35).select(F.col("id").alias("k"), (F.col("id") + 1).alias("ordinal"))
    batches = batching.with_batches(keys, 5, "ordinal")
    sunday = spark.createDataFrame([(date(2026, 9, 6),)], "run_date date")
    batching.require_within_limit(batching.daily_plan(batches, sunday, 5, 25))
    for again in (batches, batches.repartition(7)):
        assert rows(batching.keys_of_day(again, sunday), "k") == [(30,), (31,), (32,), (33,), (34,)]


def test_failure_alerts_hide_secrets(spark):
    long = "x" * 2000
    failures = spark.createDataFrame(
        [
            ("r", "j", "t", "d", "call refused: apikey=pa55phrase, Rate-Limit"),
            ("r", "j", "t", "d", None),
            ("r", "j", "t", "d", f"{long} token=zz9"),
        ],
        "run_id string, job string, task string, logical_date string, message string",
    )
    found = rows(audit.failure_alerts(failures, ["pa55phrase"]), "reason", "error")
    assert found == [
        ("rate_limit", "call refused: apikey=***REDACTED*** Rate-Limit"),
        ("task_failure", "unknown error"),
        ("task_failure", long + " token=***REDACTED***"),
    ]
