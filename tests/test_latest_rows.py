"""Stored latest rows: merged batch by batch, equal to a full rebuild, in place for joins."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, GOLD_SCHEMA, INCOME
from fiscora.plans import gold, silver
from fiscora.plans.gold import MART_COLUMNS, SilverFrames
from fiscora.plans.ingest import LakePaths, ingest
from fiscora.plans.run import latest_frames
from fiscora.sources import bronze, latest_rows
from fiscora.sources.gold_table import read_gold, recent_periods, write_gold
from helpers import EARNINGS_ARRAYS, payloads, report, rows, statement

COLUMNS = MART_COLUMNS[INCOME.name]


def income(symbol, *amounts, day="2025-12-31"):
    return statement(symbol, [report(day, totalRevenue=a) for a in amounts])


def staged(spark, *documents):
    parts = (f"cast({part}(ingest_date) as bigint) as {part}" for part in ("year", "month", "day"))
    return payloads(spark, *documents).selectExpr("raw_data", *parts)


def typed(spark, *documents):
    return silver.deliveries(staged(spark, *documents), INCOME, COLUMNS)


BATCHES = [
    [(7, income("A", 1)), (7, income("B", 2)), (7, income("C", 3, day="broken"))],
    [(8, income("A", 10)), (6, income("B", 20)), (8, income("D", 4))],
    [(8, income("A", 11, 12)), (9, income("C", 5, day="broken")), (9, {"symbol": "A", "annualReports": [], "quarterlyReports": []})],
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_merging_batches_equals_choosing_from_all(spark, tmp_path, order):
    root = str(tmp_path / "latest")
    for n in order:
        stored = latest_rows.merge(typed(spark, *BATCHES[n]), root, INCOME, {n}, buckets=3)
    assert stored.batches == {0, 1, 2}
    expected = silver.latest(typed(spark, *(d for b in BATCHES for d in b)), INCOME, COLUMNS)
    assert rows(stored.rows, *COLUMNS) == rows(expected, *COLUMNS) and stored.rows.count() == 4
    # old versions go, and a reader in another session finds the same rows
    assert len(list((Path(root) / "income_statement" / "rows").iterdir())) == latest_rows.KEPT_VERSIONS
    other = latest_rows.read(spark.newSession(), root, INCOME)
    assert rows(other.rows, *COLUMNS) == rows(expected, *COLUMNS) and other.buckets == 3


def test_only_the_new_rows_are_shuffled(spark, tmp_path, capsys):
    root = str(tmp_path / "latest")
    stored = latest_rows.merge(typed(spark, *BATCHES[0]), root, INCOME, {0}, buckets=4).rows
    fresh = typed(spark, *BATCHES[1]).repartition(4, "symbol")
    plan = silver.latest(stored.unionByName(fresh.select(*stored.columns)), INCOME, COLUMNS)
    plan.explain()
    text = capsys.readouterr().out
    assert text.count("Exchange") == 1 and "Bucketed: true" in text


def test_gold_from_stored_rows_needs_no_shuffle(spark, tmp_path, capsys):
    root = str(tmp_path / "latest")
    frames = {}
    for name, endpoint in ENDPOINTS.items():
        staging = bronze.empty_staging(spark).union(spark.range(1).selectExpr("'{}'", "2026L", "9L", "7L"))
        found = latest_rows.merge(silver.deliveries(staging, endpoint, MART_COLUMNS[name]), root, endpoint, {0}, buckets=4)
        frames[name] = found.rows.select(*MART_COLUMNS[name])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold.build_gold(SilverFrames.of(frames, by_company=True)).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    text = capsys.readouterr().out
    assert "Exchange" not in text and text.count("SortMergeJoin") == 4


def all_documents(symbol, day, revenue):
    return {
        "overview": {"Symbol": symbol, "Sector": "Technology", "PERatio": "20", "LatestQuarter": day},
        "income_statement": statement(symbol, [report(day, totalRevenue=revenue, netIncome="100")]),
        "balance_sheet": statement(symbol, [report(day, totalShareholderEquity="500")]),
        "cash_flow": statement(symbol, [report(day, operatingCashflow="120")]),
        "earnings": statement(symbol, [{"fiscalDateEnding": day, "reportedEPS": "1.5"}], arrays=EARNINGS_ARRAYS),
    }


def test_replaced_batches_and_loose_documents(spark, tmp_path):
    """A batch that is run again leaves the store, and documents outside of batches are added on each read."""
    paths = LakePaths.under(str(tmp_path / "lake"))

    def store(batch, day, document):
        for name, endpoint in ENDPOINTS.items():
            ingest(spark, payloads(spark, (day, document[name])), endpoint, paths, "r", batch=batch)

    def revenues():
        frames = latest_frames(spark, paths, buckets=2)
        return frames.by_company, rows(frames.income, "symbol", "total_revenue")

    store(0, 7, all_documents("A", "2024-12-31", 100))
    assert revenues() == (True, [("A", 100)])
    store(1, 8, all_documents("B", "2025-12-31", 200))
    assert revenues() == (True, [("A", 100), ("B", 200)])
    store(1, 8, all_documents("C", "2025-12-31", 300))
    assert revenues() == (True, [("A", 100), ("C", 300)])
    loose = payloads(spark, (9, all_documents("A", "2024-12-31", 111)["income_statement"]))
    bronze.write_bronze(loose, bronze.endpoint_path(paths.bronze, INCOME.name))
    assert revenues() == (False, [("A", 111), ("C", 300)])


def kpi_rows(spark, companies, dates):
    made = spark.range(companies * dates).selectExpr(
        f"concat('C', lpad(cast(id % {companies} as string), 4, '0')) as symbol",
        f"date_add(date'2000-01-01', cast(id div {companies} as int)) as fiscaldateending",
        f"if(id % {companies} = 7 and id div {companies} % 2 = 0, 'quarterly', 'annual') as report_type",
        "id as total_revenue",
    )
    names = {f.name: made[f.name] if f.name in made.columns else F.lit(None) for f in GOLD_SCHEMA}
    return made.select(*(names[f.name].cast(f.dataType).alias(f.name) for f in GOLD_SCHEMA))


def test_a_look_up_opens_few_files(spark, tmp_path):
    """Thirty dates, each split over several files: only the newest dates' files that may hold the company are read."""
    path = str(tmp_path / "gold")
    table = kpi_rows(spark, 40, 30)
    undated = table.where("symbol = 'C0003'").limit(1).withColumn("fiscaldateending", F.lit(None).cast("date"))
    write_gold(table.unionByName(undated), path, max_records_per_file=10)
    files = len(read_gold(spark, path).inputFiles())
    assert files > 100
    for symbol, kind, n in (("C0003", "annual", 4), ("C0007", "quarterly", 3), ("C0007", "annual", 3), ("C0003", "annual", 100)):
        found = recent_periods(spark, path, symbol, kind, n)
        expected = gold.recent_periods(read_gold(spark, path), symbol, kind, n)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]
        assert len(found.inputFiles()) <= min(3 * n, 31)
    assert recent_periods(spark, path, "C9999", "annual", 4).count() == 0
    assert recent_periods(spark, path, "C0003", "no such type", 4).count() == 0
    # a table whose writer died before the index was written
    shutil.rmtree(f"{path}/index")
    assert recent_periods(spark, path, "C0003", "annual", 4).count() == 4 and recent_periods(spark, str(tmp_path / "none"), "A", "annual").count() == 0


def test_readers_never_see_half_a_batch(spark, tmp_path, monkeypatch):
    """A batch that dies before it is finished, the first time or as a repetition, is not read; run again, it is."""
    paths = LakePaths.under(str(tmp_path / "lake"))
    folder = bronze.endpoint_path(paths.bronze, INCOME.name)

    def store(batch, symbol):
        ingest(spark, payloads(spark, (7 + batch, income(symbol, 100 + batch))), INCOME, paths, "r", batch=batch)

    def seen():
        found = latest_rows.refresh(spark, paths.bronze, paths.periods, paths.latest, INCOME, COLUMNS, buckets=2)[0]
        return bronze.read_bronze(spark, folder).count(), rows(found, "symbol", "total_revenue")

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("fiscora.plans.ingest.write_log", dies)
        with pytest.raises(RuntimeError):
            store(0, "A")
    assert (Path(folder) / "batch=0").exists() and seen() == (0, [])
    store(0, "A")
    store(1, "B")
    assert seen() == (2, [("A", 100), ("B", 101)])
    with monkeypatch.context() as patch:
        patch.setattr("fiscora.plans.ingest.write_log", dies)
        with pytest.raises(RuntimeError):
            store(1, "C")
    assert seen() == (1, [("A", 100)])
    store(1, "C")
    assert seen() == (2, [("A", 100), ("C", 101)])
