from datetime import date
from decimal import Decimal

import pytest

from fiscora.catalog import GRAIN
from fiscora.operators import quality
from helpers import rows

D = date(2025, 12, 31)
SCHEMA = "symbol string, fiscaldateending date, report_type string, note string"


def periods(spark, *data):
    return spark.createDataFrame([(*d, "x") for d in data], SCHEMA)


def test_report_counts_failures(spark):
    frame = periods(
        spark,
        ("A", D, "annual"),
        ("A", D, "annual"),
        ("A", None, "annual"),
        ("B", None, None),
        ("B", None, None),
        (None, D, "monthly"),
        (None, D, "monthly"),
        (None, D, "monthly"),
    )
    report = quality.test_report(frame, "m", quality.SILVER_TESTS["income_statement"])
    assert rows(report, "test", "column", "failures") == [
        ("accepted_values", "report_type", 3),  # NULL passes
        ("not_null", "fiscaldateending", 3),
        ("not_null", "report_type", 2),
        ("not_null", "symbol", 3),
        ("unique_combination_of_columns", ", ".join(GRAIN), 3),  # NULLs are equal
    ]


def test_unique_ignores_null(spark):
    frame = spark.createDataFrame([("A",), ("A",), ("B",), (None,), (None,)], "symbol string")
    report = quality.test_report(frame, "overview", quality.SILVER_TESTS["overview"])
    assert rows(report, "test", "failures") == [("not_null", 2), ("unique", 1)]
    assert rows(quality.unique_failures(frame, "symbol"), "symbol", "n_rows") == [("A", 2)]


def test_tests_over_different_columns(spark):
    frame = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "symbol string, n int")
    tests = quality.ModelTests(not_null=("n",), unique=("symbol",), combination=("symbol", "n"))
    assert rows(quality.test_report(frame, "m", tests), "test", "column", "failures") == [
        ("not_null", "n", 0),
        ("unique", "symbol", 1),
        ("unique_combination_of_columns", "symbol, n", 0),
    ]


def test_empty_model_passes(spark):
    report = quality.test_report(periods(spark), "m", quality.SILVER_TESTS["income_statement"])
    assert [r["failures"] for r in report.collect()] == [0] * 5
    assert quality.gate(report, "silver").first().asDict() == {
        "layer": "silver",
        "tests": 5,
        "failures": 0,
        "passed": True,
    }
    quality.require(report, "silver")


def test_gate_names_the_failing_test(spark):
    report = quality.test_report(
        periods(spark, ("A", None, "annual")), "income", quality.SILVER_TESTS["income_statement"]
    )
    assert quality.gate(report, "silver").first()["passed"] is False
    with pytest.raises(quality.QualityGateError, match=r"income.not_null\(fiscaldateending\)=1"):
        quality.require(report, "silver")


def test_reconciliation_finds_a_wrong_kpi(spark):
    schema = "symbol string, fiscaldateending date, report_type string"
    ratios = {"margin": ("net", "revenue")}
    inputs = spark.createDataFrame(
        [("A", D, "annual", 1, 3), ("B", None, "annual", 1, 0), ("C", D, "annual", 1, 4)],
        schema + ", net bigint, revenue bigint",
    )
    good = [("A", D, "annual", Decimal("0.333333333")), ("B", None, "annual", None)]
    for last, differing in ((Decimal("0.25"), 0), (Decimal("0.26"), 1), (None, 1)):
        gold = spark.createDataFrame([*good, ("C", D, "annual", last)], schema + ", margin decimal(38,9)")
        found = quality.reconcile_kpis(gold, inputs, ratios).first()
        assert (found["kpi"], found["compared"], found["differing"]) == ("margin", 3, differing)
    short = spark.createDataFrame(good, schema + ", margin decimal(38,9)")
    assert quality.reconcile_kpis(short, inputs, ratios).first()["differing"] == 1  # a lost row
