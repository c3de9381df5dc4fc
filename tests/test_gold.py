from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from fiscora.catalog import BALANCE, CASH_FLOW, EARNINGS, GOLD_SCHEMA, GRAIN, INCOME, OVERVIEW
from fiscora.operators.quality import schema_mismatches
from fiscora.plans import gold
from fiscora.sources.gold_table import read_gold, write_gold
from helpers import dec, rows

D25, D24 = date(2025, 12, 31), date(2024, 12, 31)
INPUTS = {
    "income": (INCOME, gold.INCOME_COLUMNS),
    "balance": (BALANCE, gold.BALANCE_COLUMNS),
    "cash_flow": (CASH_FLOW, gold.CASH_FLOW_COLUMNS),
    "earnings": (EARNINGS, gold.EARNINGS_COLUMNS),
    "overview": (OVERVIEW, gold.OVERVIEW_COLUMNS),
}


def build(spark, **data):
    """The mart from literal Silver rows; inputs not given are typed and empty."""
    frames = {}
    for name, (endpoint, columns) in INPUTS.items():
        schema = ", ".join(f"`{c}` {endpoint.column_type(c).simpleString()}" for c in columns)
        frames[name] = spark.createDataFrame(data.get(name, []), schema)
    return gold.build_gold(gold.SilverFrames(**frames))


def income(symbol, day, kind, revenue=None, net=None, ebitda=None):
    return (symbol, day, kind, "USD", date(2026, 9, 8), revenue, net, ebitda)


def quotient(a, b):
    """Nine digits, half up; NULL where there is nothing to divide by."""
    if a is None or not b:
        return None
    return (Decimal(a) / Decimal(b)).quantize(Decimal("0.000000001"), rounding=ROUND_HALF_UP)


REVENUE, NET, EBITDA, EQUITY, ASSETS, LIABILITIES, DEBT, OPERATING, FREE = 8431, -377, 1290, 5005, 702, 649, -88, 1111, 1024
AMOUNTS = (EQUITY, ASSETS, LIABILITIES, DEBT)
FULL = {
    "income": [income("GNU", D25, "annual", REVENUE, NET, EBITDA)],
    "balance": [("GNU", D25, "annual", *AMOUNTS)],
    "cash_flow": [("GNU", D25, "annual", OPERATING, FREE)],
    "earnings": [("GNU", D25, "annual", dec("-3.75"))],
    "overview": [("GNU", "Energy", "Wind", "Denmark", "XCSE", date(2026, 9, 2), dec("17.5"), dec("0.125"))],
}


def test_all_kpis_and_columns(spark):
    frame = build(spark, **FULL)
    assert schema_mismatches(frame, GOLD_SCHEMA) == []
    expected = {
        "symbol": "GNU", "fiscaldateending": D25, "report_type": "annual", "reportedcurrency": "USD",
        "ingest_date": date(2026, 9, 8), "overview_snapshot_date": date(2026, 9, 2),
        "sector": "Energy", "industry": "Wind", "country": "Denmark", "exchange": "XCSE",
        "total_revenue": REVENUE, "net_income": NET, "ebitda_calc": EBITDA, "operating_cashflow": OPERATING,
        "total_shareholder_equity": EQUITY, "total_current_assets": ASSETS, "total_current_liabilities": LIABILITIES,
        "net_debt": DEBT, "roe": quotient(NET, EQUITY), "net_margin": quotient(NET, REVENUE),
        "ebitda_margin": quotient(EBITDA, REVENUE), "net_debt_to_ebitda": quotient(DEBT, EBITDA),
        "current_ratio": quotient(ASSETS, LIABILITIES), "free_cash_flow": FREE,
        "quality_of_earnings": quotient(OPERATING, NET), "revenue_yoy_growth": None,
        "earnings_surprise_pct": dec("-3.75"), "pe_ratio": dec("17.5"), "ev_to_ebitda": dec("0.125"),
    }
    assert [r.asDict() for r in frame.collect()] == [expected]


def test_companions_match_on_the_whole_key(spark):
    """Companions of another company, frequency or date give nothing, and no rows of their own."""
    keys = [("GNU", D25, "annual"), ("GNU", D24, "annual"), ("GNU", D25, "quarterly"), ("EMU", D25, "annual")]
    for own in keys:
        others = [k for k in keys if k != own] + [("YAK", D25, "annual")]
        frame = build(
            spark,
            income=[income(*own, REVENUE, NET, EBITDA)],
            balance=[(*k, *AMOUNTS) for k in others],
            cash_flow=[(*k, OPERATING, FREE) for k in others],
            earnings=[(*k, dec("1")) for k in others],
            overview=[("YAK", *FULL["overview"][0][1:])],
        )
        assert rows(frame, *GRAIN, "roe", "free_cash_flow", "earnings_surprise_pct", "pe_ratio") == [(*own, None, None, None, None)]


@pytest.mark.parametrize("nothing", [0, None])
def test_nothing_to_divide_by(spark, nothing):
    frame = build(
        spark,
        income=[income("GNU", D24, "annual", nothing), income("GNU", D25, "annual", nothing, nothing, nothing)],
        balance=[("GNU", D25, "annual", nothing, ASSETS, nothing, DEBT)],
        cash_flow=[("GNU", D25, "annual", OPERATING, FREE)],
    )
    last = frame.where(F.col("fiscaldateending") == F.lit(D25))
    assert rows(last, *gold.RATIOS, "revenue_yoy_growth") == [(None,) * 7]


def test_growth_counts_four_quarters_or_one_year(spark):
    ends = [date(2023 + i // 4, 3 * (i % 4) + 1, 15) for i in range(9)]
    quarters, years = [31, 0, 47, None, 53, 59, 61, 67, 71], [601, 599, None, 11, 0, 13]
    frame = build(
        spark,
        income=[income("GNU", d, "quarterly", r) for d, r in zip(ends, quarters, strict=True)]
        + [income("GNU", date(2015 + i, 1, 31), "annual", r) for i, r in enumerate(years)]
        + [income("EMU", d, "quarterly", 5) for d in ends[:4]],
    )

    def expected(revenues, step):
        pairs = [(r, revenues[i - step] if i >= step else None) for i, r in enumerate(revenues)]
        return [None if r is None or p is None else quotient(r - p, p) for r, p in pairs]

    found = {(r["symbol"], r["report_type"], r["fiscaldateending"]): r["revenue_yoy_growth"] for r in frame.collect()}
    assert [found["GNU", "quarterly", d] for d in ends] == expected(quarters, 4)
    assert [found["GNU", "annual", date(2015 + i, 1, 31)] for i in range(6)] == expected(years, 1)
    assert [found["EMU", "quarterly", d] for d in ends[:4]] == [None] * 4


def test_growth_between_extremes(spark):
    low, high = -(2**63), 2**63 - 1
    frame = build(spark, income=[income("T", D24, "annual", low), income("T", D25, "annual", high)])
    assert rows(frame, "fiscaldateending", "revenue_yoy_growth") == [(D24, None), (D25, quotient(high - low, low))]


def test_null_dates_are_kept_and_match_nothing(spark):
    frame = build(
        spark,
        income=[income("GNU", None, "annual", REVENUE, NET, EBITDA)],
        balance=[("GNU", None, "annual", *AMOUNTS)],
    )
    columns = ["fiscaldateending", "net_margin", "roe", "revenue_yoy_growth"]
    assert rows(frame, *columns) == [(None, quotient(NET, REVENUE), None, None)]


def test_empty_income_gives_no_rows(spark):
    assert build(spark, **{k: v for k, v in FULL.items() if k != "income"}).count() == 0


def test_write_and_read_back(spark, tmp_path):
    frame = build(
        spark,
        income=[
            income(s, d, k, REVENUE, NET, EBITDA) for s in "BA" for d in (D24, D25, None) for k in ("annual", "quarterly")
        ],
        overview=FULL["overview"],
    )
    path = str(tmp_path / "gold")
    write_gold(frame, path)
    write_gold(frame, path)  # a rebuild replaces, never appends
    stored = read_gold(spark, path)
    assert schema_mismatches(stored, GOLD_SCHEMA) == []
    assert rows(stored, *GOLD_SCHEMA.names) == rows(frame, *GOLD_SCHEMA.names)
    one_day = stored.where(F.col("fiscaldateending") == F.lit(D25))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscaldateending" in plan
    assert one_day.count() == 4


def test_a_hot_date_is_split_over_files(spark, tmp_path):
    """Nearly all rows close on one day; no single task may have to write them all."""
    day = F.when(F.col("id") % 100 == 0, F.lit(D24)).otherwise(F.lit(D25))
    columns = {"symbol": F.concat(F.lit("S"), F.col("id").cast("string")), "fiscaldateending": day}
    frame = spark.range(60000).select(
        *(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in GOLD_SCHEMA)
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "128KB")
    try:
        write_gold(frame, str(tmp_path))
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "version=0" / "fiscaldateending=2025-12-31").glob("*.parquet"))) > 3
    assert read_gold(spark, str(tmp_path)).count() == 60000


def test_recent_periods(spark):
    days = [date(2020 + i, 12, 31) for i in range(6)]
    frame = build(spark, income=[income("A", d, "annual", 1) for d in days] + [income("B", D25, "annual", 1)])
    newest = gold.recent_periods(frame, "A", "annual", 4).select("symbol", "fiscaldateending").collect()
    assert [tuple(r) for r in newest] == [("A", d) for d in reversed(days[2:])]


def shuffle_joins(spark, frame):
    """Physical plan as it would be for inputs too large to broadcast."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        return frame()._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_mart_needs_one_shuffle_per_input_and_one_by_symbol(spark):
    from fiscora.sources.bronze import empty_staging

    names = ["overview", "income_statement", "balance_sheet", "cash_flow", "earnings"]
    plan = shuffle_joins(
        spark,
        lambda: gold.gold_from_bronze(
            {n: empty_staging(spark).union(spark.range(1).selectExpr("'{}'", "id", "id", "id")) for n in names}
        ),
    )
    assert plan.count("Exchange hashpartitioning") == len(names) + 1
    # every document is parsed once, though joins test its key for NULL
    assert plan.count("inline(array(from_json(") == len(names)
    # the group limit runs on both sides of every deduplication shuffle
    assert plan.count("row_number(), 1, Partial") == plan.count("row_number(), 1, Final") == len(names)


@pytest.mark.parametrize("hot_share", [3])
def test_hot_company(spark, hot_share):
    """One company holds a third of all documents; the result does not change."""
    from fiscora.plans import silver
    from helpers import report, staging, statement

    documents = []
    for i in range(90):
        symbol = "HOT" if i % hot_share == 0 else f"S{i}"
        documents.append((1 + i % 28, statement(symbol, [report("2025-12-31", totalRevenue=str(i))])))
    model = silver.income_statement(staging(spark, *documents))
    newest = {}
    for day, doc in documents:
        value = (day, int(doc["annualReports"][0]["totalRevenue"]))
        newest.setdefault(doc["symbol"], []).append(value)
    found = dict(rows(model, "symbol", "total_revenue"))
    assert set(found) == set(newest)
    for symbol, seen in newest.items():
        best_day = max(d for d, _ in seen)
        assert found[symbol] in [v for d, v in seen if d == best_day]
