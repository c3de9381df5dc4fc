import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, INCOME
from fiscora.operators import audit
from fiscora.operators.quality import QualityGateError
from fiscora.plans import silver
from fiscora.plans.gold import gold_from_bronze
from fiscora.plans.ingest import LakePaths
from fiscora.plans.run import BatchError, run
from fiscora.sources import audit_log, bronze
from helpers import EARNINGS_ARRAYS, dec, payloads, report, rows, statement


def documents(symbol, revenue="1000"):
    day = "2025-12-31"
    return {
        "overview": {"Symbol": symbol, "Sector": "Technology", "PERatio": "20", "LatestQuarter": day},
        "income_statement": statement(symbol, [report(day, totalRevenue=revenue, netIncome="100")]),
        "balance_sheet": statement(symbol, [report(day, totalShareholderEquity="500")]),
        "cash_flow": statement(symbol, [report(day, operatingCashflow="120", capitalExpenditures="30")]),
        "earnings": statement(symbol, [{"fiscalDateEnding": day, "reportedEPS": "1.5"}], arrays=EARNINGS_ARRAYS),
    }


def landing(spark, day, *companies):
    return {name: payloads(spark, *((day, c[name]) for c in companies)) for name in ENDPOINTS}


def test_two_runs(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    first = run(spark, landing(spark, 7, documents("A"), documents("B")), paths, "run-1")
    assert rows(first.summaries, "endpoint", "status", "completed") == [(n, "SUCCESS", 2) for n in sorted(ENDPOINTS)]
    columns = ["symbol", "net_margin", "roe", "free_cash_flow", "sector", "pe_ratio"]
    assert rows(first.gold, *columns) == [
        (s, dec("0.1"), dec("0.2"), 90, "Technology", dec("20")) for s in ("A", "B")
    ]
    assert first.silver_report.agg(F.sum("failures")).first()[0] == 0

    # the same period again is skipped, so the restated revenue does not arrive
    second = run(spark, landing(spark, 8, documents("A", revenue="2000")), paths, "run-2")
    assert rows(second.summaries, "status", "watermark_skips") == [("SUCCESS", 1)] * 5
    assert rows(second.gold, *columns) == rows(first.gold, *columns)
    logged = audit_log.read_batch_summaries(spark, f"{paths.audit}/runs")
    assert rows(logged.groupBy("run_id").count(), "run_id", "count") == [("run-1", 5), ("run-2", 5)]


def test_a_run_parses_new_batches_only(spark, tmp_path):
    """Gold of three runs equals Gold from Bronze; typed rows of old batches stay as they are."""
    paths = LakePaths.under(str(tmp_path / "lake"))
    for number, symbols in enumerate(("AB", "C", "D")):
        result = run(spark, landing(spark, 7 + number, *(documents(s) for s in symbols)), paths, f"run-{number}")
        folder = Path(paths.periods) / "income_statement"
        assert sorted(p.name for p in folder.iterdir()) == [f"batch={n}" for n in range(number + 1)]
        written = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet") if f"batch={number}" not in str(p)}
        if number:
            assert written.items() >= before.items()
        before = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    stores = {n: bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, n)) for n in ENDPOINTS}
    columns = result.gold.columns
    assert rows(result.gold, *columns) == rows(gold_from_bronze(stores), *columns) and result.gold.count() == 4


def test_a_plan_above_the_daily_limit_is_refused(spark, tmp_path):
    planned = spark.createDataFrame([("r", name, s) for name in ENDPOINTS for s in "AB"], "run_id string, endpoint string, symbol string")
    paths = LakePaths.under(str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="above the daily limit"):
        run(spark, landing(spark, 7, documents("A")), paths, "r", planned=planned, daily_limit=9)
    assert not Path(paths.bronze).exists()
    assert run(spark, landing(spark, 7, documents("A")), paths, "r", planned=planned, daily_limit=10).gold.count() == 1


def test_partial_and_strict_runs(spark, tmp_path):
    broken = {**documents("B"), "cash_flow": {}}
    planned = spark.createDataFrame(
        [("r", name, s) for name in ENDPOINTS for s in "AB"], "run_id string, endpoint string, symbol string"
    )
    paths = LakePaths.under(str(tmp_path / "lake"))
    result = run(spark, landing(spark, 7, documents("A"), broken), paths, "r", planned=planned)
    found = {r["endpoint"]: (r["status"], r["completed"], r["pending"]) for r in result.summaries.collect()}
    assert found.pop("cash_flow") == (audit.PARTIAL_SUCCESS, 1, 1)
    assert set(found.values()) == {(audit.SUCCESS, 2, 0)}
    assert result.gold.count() == 2  # the rebuild goes on without the failed document
    with pytest.raises(BatchError, match="cash_flow"):
        strict = LakePaths.under(str(tmp_path / "strict"))
        run(spark, landing(spark, 7, documents("A"), broken), strict, "r", planned=planned, allow_partial=False)


def test_gold_waits_for_the_silver_gate(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    spoilt = statement("A", [report("broken-date", totalRevenue="1")])
    bronze.write_bronze(payloads(spark, (7, spoilt)), bronze.endpoint_path(paths.bronze, "income_statement"))
    only_overview = {"overview": payloads(spark, (7, documents("A")["overview"]))}
    with pytest.raises(QualityGateError, match=r"income_statement.not_null\(fiscaldateending\)=1"):
        run(spark, only_overview, paths, "r")
    assert not Path(paths.gold).exists()


def test_all_documents_rejected_leaves_empty_bronze(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    result = run(spark, {"income_statement": payloads(spark, (7, "{}"))}, paths, "r")
    assert result.gold.count() == 0
    assert bronze.read_bronze(spark, bronze.endpoint_path(paths.bronze, INCOME.name)).count() == 0


def test_views_carry_the_model_names(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for name, document in documents("A").items():
        bronze.write_bronze(payloads(spark, (7, document)), bronze.endpoint_path(root, name))
    bronze.register_staging(spark, root, list(ENDPOINTS))
    models = ["overview", "income_statement", "balance_sheet", "cash_flow", "earning"]
    assert all(spark.table(f"stg_{m}").columns == ["raw_data", "year", "month", "day"] for m in models)
    silver.register_silver(spark, {n: spark.table(f"stg_{e.model}") for n, e in ENDPOINTS.items()})
    joined = spark.sql("SELECT symbol, reported_eps FROM int_earning JOIN int_overview USING (symbol)")
    assert rows(joined, "symbol", "reported_eps") == [("A", dec("1.5"))]


def test_command_line(spark, tmp_path):
    for name, document in documents("A").items():
        bronze.write_bronze(payloads(spark, (7, document)), bronze.endpoint_path(str(tmp_path / "landing"), name))
    command = [sys.executable, "-m", "fiscora", "--landing", str(tmp_path / "landing")]
    command += ["--lake", str(tmp_path / "lake"), "--run-id", "cli"]
    repo = Path(__file__).resolve().parents[1]
    quiet = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false --master local[2] pyspark-shell"}
    done = subprocess.run(command, cwd=repo, env=quiet, capture_output=True, text=True, timeout=300, check=False)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("SUCCESS") == 5
