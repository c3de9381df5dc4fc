import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from fiscora.catalog import GOLD_SCHEMA, INCOME, OVERVIEW
from fiscora.operators import quality, watermark
from fiscora.plans import silver
from fiscora.plans import ingest as ingest_plan
from fiscora.plans.ingest import LakePaths, accepted_documents, decide, ingest, processed_keys, stage
from fiscora.sources import audit_log, bronze, state, versions
from fiscora.sources.gold_table import write_gold
from fiscora.streaming.ingest import start_ingest
from helpers import payloads, report, rows, statement

STATE = "endpoint string, symbol string, fiscal_date string"


def candidates(spark, *documents):
    """Rows of ``(symbol, fiscal_date, day[, hash])``."""
    data = [("overview", d[0], d[1], date(2026, 9, d[2]), d[3] if len(d) > 3 else i, i) for i, d in enumerate(documents)]
    return spark.createDataFrame(
        data, "endpoint string, symbol string, fiscal_date string, ingest_date date, payload_hash bigint, document bigint"
    )


@pytest.mark.parametrize(
    ("symbol", "fiscal_date", "expected"),
    [
        ("YAK", "2019-02-28", True),
        ("ORB", "2020-05-31", True),
        ("orb", "2020-05-31", True),
        ("ORB", "2019-05-31", False),
        ("orb", "2019-05-31", False),
        ("ORB", "2018-05-31", False),
        ("ORB", None, True),
        ("ORB", "", True),
        ("ORB", "later", True),  # text comparison
    ],
)
def test_watermark_decision(spark, symbol, fiscal_date, expected):
    stored = spark.createDataFrame([("overview", "ORB", "2019-05-31"), ("other", "YAK", "2030-01-01")], STATE)
    marked = watermark.mark_new(candidates(spark, (symbol, fiscal_date, 8)), stored)
    assert [r["is_new"] for r in marked.collect()] == [expected]


def test_earlier_days_raise_the_mark(spark):
    documents = [("A", "2024-03-31", 7), ("A", "2024-03-31", 8), ("A", "2024-06-30", 9), ("A", "2023-12-31", 10)]
    marked = watermark.mark_new(candidates(spark, *documents), state.empty_state(spark))
    assert sorted(rows(marked, "ingest_date", "is_new")) == [
        (date(2026, 9, 7), True),
        (date(2026, 9, 8), False),
        (date(2026, 9, 9), True),
        (date(2026, 9, 10), False),
    ]


def sequential(documents, stored):
    """Brute force: days in order, the best document of a company and day, one mark per company."""
    mark, accepted = dict(stored), []
    by_day = {}
    for symbol, fiscal_date, day, content in documents:
        if fiscal_date:
            by_day.setdefault((day, symbol.upper()), []).append((fiscal_date, content))
        else:
            accepted.append((symbol.upper(), day, content))
    for (day, key), seen in sorted(by_day.items()):
        best = max(seen)
        if key not in mark or best[0] > mark[key]:
            mark[key] = best[0]
            accepted.append((key, day, best[1]))
    return sorted(accepted), mark


def test_watermark_matches_sequential_processing(spark):
    """Random batches with one company holding a third of all documents."""
    rng = random.Random(3)
    stored = {f"S{i}": f"202{i % 5}-12-31" for i in range(0, 20, 2)}
    documents = []
    for content in range(400):
        symbol = "hot" if content % 3 == 0 else f"s{rng.randrange(20)}"
        fiscal_date = rng.choice([None, "", *(f"202{y}-{m}-30" for y in range(6) for m in ("06", "09"))])
        documents.append((symbol, fiscal_date, rng.randrange(1, 28), content))
    accepted, mark = sequential(documents, stored)
    state_rows = spark.createDataFrame([("overview", k, d) for k, d in stored.items()], STATE)
    new = watermark.filter_new(candidates(spark, *documents), state_rows)
    assert rows(new.select(F.upper("symbol"), F.day("ingest_date"), "payload_hash"), "*") == sorted(accepted, key=repr)
    advanced = watermark.advance(state_rows, new)
    assert {r["symbol"]: r["fiscal_date"] for r in advanced.collect()} == mark


def test_one_of_identical_copies_is_new(spark):
    """Equal documents of a company and day, among others of that day: one is stored."""
    documents = [("A", "2024-03-31", 7, 5)] * 3 + [("A", "2023-03-31", 7, 6), ("B", "2024-03-31", 7, 5), ("A", "2024-03-31", 8, 5)]
    marked = watermark.mark_new(candidates(spark, *documents), state.empty_state(spark))
    assert sorted(rows(marked.where("is_new"), "symbol", "ingest_date", "payload_hash")) == [
        ("A", date(2026, 9, 7), 5),
        ("B", date(2026, 9, 7), 5),
    ]


def marks(spark, *pairs):
    return spark.createDataFrame([("overview", s, d) for s, d in pairs], STATE)


def test_state_increments(spark, tmp_path):
    root = str(tmp_path / "state")
    assert state.read_state(spark, root).count() == 0 and state.next_number(spark, root) == 0
    state.write_increment(marks(spark, ("ORB", "2021-03-31")), root, 0)
    raised = watermark.raised(state.read_state(spark, root), candidates(spark, ("orb", "2022-03-31", 8), ("zed", None, 8)))
    assert rows(raised, "*") == [("overview", "ORB", "2022-03-31")]
    state.write_increment(raised, root, 1)
    assert rows(state.read_state(spark, root), "*") == [("overview", "ORB", "2022-03-31")]
    assert rows(state.read_state(spark, root, before=1), "*") == [("overview", "ORB", "2021-03-31")]
    # an increment without its marker was cut short and does not count
    (tmp_path / "state" / "increment=1" / "_SUCCESS").unlink()
    assert rows(state.read_state(spark, root), "*") == [("overview", "ORB", "2021-03-31")]
    assert state.next_number(spark, root) == 1


def test_unchanged_batches_rewrite_nothing_and_old_state_goes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "COMPACT_AFTER", 3)
    root = str(tmp_path / "state")
    for number in range(14):
        known = state.read_state(spark, root, before=number)
        news = candidates(spark, ("a", f"20{10 + number // 2}-12-31", 8), ("b", "2001-12-31", 8))
        state.write_increment(watermark.raised(known, news), root, number)
        assert rows(state.read_state(spark, root), "symbol", "fiscal_date") == [("A", f"20{10 + number // 2}-12-31"), ("B", "2001-12-31")]
        if number % 2:  # the same dates again
            assert spark.read.schema(state.STATE_SCHEMA).parquet(f"{root}/increment={number}").count() == 0
    kept = sorted(p.name for p in (tmp_path / "state").iterdir())
    assert len([k for k in kept if k.startswith("snapshot")]) == 2 and len(kept) <= 2 + 2 * (3 + 1)


def test_unreadable_state_counts_as_empty(spark, tmp_path, caplog):
    root = str(tmp_path / "state")
    state.write_increment(marks(spark, ("ORB", "2021-03-31")), root, 0)
    state.write_increment(marks(spark, ("ZED", "2021-03-31")), root, 1)
    for part in (tmp_path / "state" / "increment=0").glob("*part*"):
        part.unlink()
    (tmp_path / "state" / "increment=0" / "part-0.parquet").write_text("not a table")
    assert rows(state.read_state(spark, root), "symbol") == [("ZED",)]
    assert "unreadable" in caplog.text


def test_gold_versions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "gold")
    for _ in range(5):
        write_gold(spark.createDataFrame([], GOLD_SCHEMA), root)
    assert list(versions.versions(spark, root)) == [4, 3, 2]


def test_bronze_layout_and_pruning(spark, tmp_path):
    path = str(tmp_path / "bronze" / "income_statement")
    pretty = json.dumps(statement("A", [report("2025-12-31")]), indent=1)
    bronze.write_bronze(payloads(spark, (7, pretty), (8, statement("B"))), path)
    assert (tmp_path / "bronze/income_statement/year=2026/month=09/day=07").is_dir()
    read = bronze.read_bronze(spark, path)
    assert read.schema.simpleString() == "struct<raw_data:string,year:bigint,month:bigint,day:bigint>"
    assert read.count() == 2  # one line per document, whatever its layout was
    assert json.loads(read.where("day = 7").first()["raw_data"]) == json.loads(pretty)
    pruned = read.where("day = 8")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in pruned
    bronze.write_bronze(payloads(spark, (8, statement("C"))), path)
    assert read.sparkSession.read.text(path).count() == 3


def test_full_ingest_run(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    good = {"Symbol": "ORB", "LatestQuarter": "2026-06-30", "MarketCapitalization": 12.0}
    first = ingest(
        spark,
        payloads(spark, (7, good), (7, {**good, "Symbol": "YAK", "New": 1}), (7, "{}")),
        OVERVIEW,
        paths,
        "run-0",
    )
    assert rows(first, "route") == [("accepted",), ("quarantine",), ("rejected",)]
    stored = bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, "overview"))
    document = json.loads(stored.first()["raw_data"])
    assert document["extraction_date"] == "2026-09-07"
    assert silver.overview(stored).first()["market_capitalization"] == 12
    held = bronze.read_bronze(spark, bronze.quarantine_path(paths.bronze, "overview"))
    assert [json.loads(r["raw_data"])["New"] for r in held.collect()] == [1]  # the original document

    newer = {**good, "LatestQuarter": "2026-09-30"}
    second = ingest(spark, payloads(spark, (8, good), (9, newer)), OVERVIEW, paths, "run-1")
    assert rows(second, "ingest_date", "route") == [(date(2026, 9, 8), "no_change"), (date(2026, 9, 9), "accepted")]
    assert rows(state.read_state(spark, paths.state_of(OVERVIEW)), "symbol", "fiscal_date") == [("ORB", "2026-09-30")]
    assert bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, "overview")).count() == 2
    events = audit_log.read_ticker_events(spark, f"{paths.audit}/overview")
    # a skipped document writes no event
    assert rows(events, "run_id", "status", "rows_processed") == [
        ("run-0", "ERROR", 1),
        ("run-0", "QUARANTINE", 1),
        ("run-0", "SUCCESS", 1),
        ("run-1", "SUCCESS", 1),
    ]
    assert rows(processed_keys(second, "run-1"), "run_id", "endpoint", "symbol", "route") == [
        ("run-1", "overview", "ORB", "accepted"),
        ("run-1", "overview", "ORB", "no_change"),
    ]


def test_a_batch_that_died_is_replaced_whole(spark, tmp_path, monkeypatch):
    """It dies before its state; the same number then brings other days."""
    paths = LakePaths.under(str(tmp_path))
    kinds = ({"New": 1}, {}, None)

    def delivery(day, quarter):
        good = {"Symbol": "ORB", "LatestQuarter": quarter}
        return payloads(spark, *((day, "{}" if extra is None else {**good, **extra}) for extra in kinds))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("fiscora.plans.ingest.write_increment", die)
        with pytest.raises(RuntimeError):
            ingest(spark, delivery(7, "2026-03-31"), OVERVIEW, paths, "died")
    assert state.next_number(spark, paths.state_of(OVERVIEW)) == 0
    ingest(spark, delivery(8, "2026-06-30"), OVERVIEW, paths, "again")
    for path in (bronze.endpoint_path(paths.bronze, "overview"), bronze.quarantine_path(paths.bronze, "overview")):
        assert rows(bronze.read_bronze(spark, path), "day") == [(8,)]
    decisions = spark.read.parquet(f"{paths.decisions}/overview")
    assert {r["ingest_date"] for r in decisions.collect()} == {date(2026, 9, 8)}
    assert {r["run_id"] for r in audit_log.read_ticker_events(spark, f"{paths.audit}/overview").collect()} == {"again"}


def test_texts_stay_out_of_the_watermark_shuffle(spark, tmp_path):
    """Broadcast off: no exchange holds a text but the one of accepted documents, which is filtered first."""
    staged = stage(payloads(spark, *((7, statement(s, [report("2024-12-31")])) for s in "ABC")), INCOME, str(tmp_path / "staged"))
    off = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        plan = decide(staged, state.empty_state(spark))._jdf.queryExecution().executedPlan().toString()
        assert "raw_data" not in plan and "Exchange" in plan
        decide(staged, state.empty_state(spark)).write.parquet(str(tmp_path / "decisions"))
        decisions = spark.read.parquet(str(tmp_path / "decisions"))
        stored = accepted_documents(staged, decisions, INCOME)
        assert "might_contain" in stored._jdf.queryExecution().optimizedPlan().toString()
        assert stored.count() == 3
    finally:
        for key in off:
            spark.conf.unset(key)


@pytest.mark.parametrize(("limit", "join"), [(3, "BroadcastHashJoin"), (2, "ShuffledHashJoin")])
def test_texts_are_not_sorted_to_meet_their_decisions(spark, tmp_path, monkeypatch, limit, join):
    """Whatever Spark takes for small: few numbers are broadcast, with many the texts meet a hash table."""
    monkeypatch.setattr(ingest_plan, "BROADCAST_NUMBERS", limit)
    staged = stage(payloads(spark, *((7, statement(s, [report("2024-12-31")])) for s in "ABC")), INCOME, str(tmp_path / "staged"))
    decide(staged, state.empty_state(spark)).write.parquet(str(tmp_path / "decisions"))
    decisions = spark.read.parquet(str(tmp_path / "decisions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        stored = accepted_documents(staged, decisions, INCOME)
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "SortMergeJoin" not in plan
        assert stored.count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replayed_batch_number_changes_nothing(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    documents = payloads(spark, (7, statement("A", [report("2025-12-31", totalRevenue="1")])))
    for run in ("first", "again"):
        ingest(spark, documents, INCOME, paths, run, batch=5)
    path = bronze.endpoint_path(paths.bronze, INCOME.name)
    assert bronze.read_bronze(spark, path).count() == 1
    assert state.next_number(spark, paths.state_of(INCOME)) == 6


def test_same_documents_as_a_new_batch_add_nothing(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    documents = payloads(spark, *((7, statement(s, [report("2025-12-31", totalRevenue="1")])) for s in "ABC"))
    path = bronze.endpoint_path(paths.bronze, INCOME.name)
    ingest(spark, documents, INCOME, paths, "first")
    before = silver.income_statement(bronze.read_bronze(spark, path)).select("symbol", "total_revenue").collect()
    second = ingest(spark, documents, INCOME, paths, "second")
    assert rows(second, "route") == [("no_change",)] * 3
    after = silver.income_statement(bronze.read_bronze(spark, path)).select("symbol", "total_revenue").collect()
    assert sorted(before) == sorted(after)


def test_stream_takes_each_file_once(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def deliver(*documents):
        bronze.write_bronze(payloads(spark, *documents), landing)

    def run():
        start_ingest(spark, landing, INCOME, paths, checkpoint, max_files=1).awaitTermination()
        return bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, INCOME.name)).count()

    deliver((7, statement("A", [report("2024-12-31")])), (7, statement("B", [report("2024-12-31")])))
    assert run() == 2
    assert run() == 2  # nothing new
    deliver((8, statement("A", [report("2024-12-31")])), (8, statement("B", [report("2025-12-31")])))
    assert run() == 3  # only B has a newer period
    marks = rows(state.read_state(spark, paths.state_of(INCOME)), "symbol", "fiscal_date")
    assert marks == [("A", "2024-12-31"), ("B", "2025-12-31")]
    with pytest.raises(ValueError, match="already fed"):
        start_ingest(spark, landing, INCOME, paths, str(tmp_path / "another checkpoint"))


def test_snapshots_compare_keys(spark):
    before = spark.createDataFrame([("A", 1), ("A", 1), ("B", None)], "s string, n int")
    after = spark.createDataFrame([("B", None), ("C", 1)], "s string, n int")
    found = quality.compare_snapshots(before, after, ["s", "n"]).first().asDict()
    assert found == {
        "rows_before": 3,
        "rows_after": 2,
        "duplicates_before": 1,
        "duplicates_after": 0,
        "keys_added": 1,
        "keys_lost": 1,
    }


def test_later_delivery_of_a_day_wins(spark, tmp_path):
    """Two batches on one day: Silver shows the second, whatever the contents hash to."""
    for i in range(4):
        paths = LakePaths.under(str(tmp_path / str(i)))
        older = statement("A", [report("2024-12-31", totalRevenue=str(i))])
        newer = statement("A", [report("2025-12-31"), report("2024-12-31", totalRevenue=str(100 + i))])
        for document in (older, newer):
            ingest(spark, payloads(spark, (7, document)), INCOME, paths, "r")
        stored = bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, INCOME.name))
        found = silver.income_statement(stored).where("fiscaldateending = '2024-12-31'")
        assert rows(found, "total_revenue") == [(100 + i,)]
