import random
from datetime import date

import pytest

from fiscora.catalog import BALANCE, CASH_FLOW, EARNINGS, ENDPOINTS, INCOME, OVERVIEW
from fiscora.plans import silver
from helpers import EARNINGS_ARRAYS, dec, report, rows, staging, statement

# model, probed field, its column, value parser
STATEMENTS = [
    (INCOME, "totalRevenue", "total_revenue", int, "9223372036854775808"),
    (BALANCE, "totalAssets", "total_assets", int, "9223372036854775808"),
    (CASH_FLOW, "operatingCashflow", "operating_cashflow", int, "9223372036854775808"),
    (EARNINGS, "reportedEPS", "reported_eps", dec, "1e100"),
]


def document(endpoint, annual=(), quarterly=()):
    return statement("GNU", annual, quarterly, arrays=endpoint.arrays)


@pytest.mark.parametrize(("endpoint", "field", "column", "parse", "too_large"), STATEMENTS)
def test_the_newest_delivery_of_a_period_counts(spark, endpoint, field, column, parse, too_large):
    """Three deliveries; each restates other periods, and frequencies do not touch each other."""
    spring, autumn = "2021-04-30", "2021-10-31"

    def sent(**by_date):
        return [report(day, **{field: value}) for day, value in by_date.values()]

    deliveries = [
        (3, document(endpoint, sent(a=(spring, "11"), b=(autumn, "12")), sent(a=(spring, "13")))),
        (4, document(endpoint, sent(a=(spring, "21")))),
        (9, document(endpoint, (), sent(a=(autumn, "34")))),
    ]
    model = silver.MODELS[endpoint.name](staging(spark, *reversed(deliveries)))
    found = {(r["report_type"], str(r["fiscaldateending"])): (r[column], r["ingest_date"].day) for r in model.collect()}
    assert found == {
        ("annual", spring): (parse("21"), 4),
        ("annual", autumn): (parse("12"), 3),
        ("quarterly", spring): (parse("13"), 3),
        ("quarterly", autumn): (parse("34"), 9),
    }


@pytest.mark.parametrize(("endpoint", "field", "column", "parse", "too_large"), STATEMENTS)
def test_unreadable_values_leave_the_row(spark, endpoint, field, column, parse, too_large):
    unreadable = ["None", "N/A", "-", "", "twelve", "1 2", too_large, None, {"a": 1}]
    days = [f"2019-{m:02}-11" for m in range(1, len(unreadable) + 1)]
    reports = [report(day, **{field: value}) for day, value in zip(days, unreadable, strict=True)]
    reports += [report("11/2019", **{field: "7"}), report("2019-13-01", **{field: "8"})]
    model = silver.MODELS[endpoint.name](staging(spark, (2, document(endpoint, reports[:-1], reports[-1:]))))
    found = {r["fiscaldateending_raw"]: (r["fiscaldateending"], r[column]) for r in model.collect()}
    assert found == {d: (date.fromisoformat(d), None) for d in days} | {
        "11/2019": (None, parse("7")),
        "2019-13-01": (None, parse("8")),
    }


@pytest.mark.parametrize("foreign", [5, "text", None, [1, 2], True])
def test_a_foreign_element_costs_one_row(spark, foreign):
    raw = document(INCOME, [report("2018-06-30", totalRevenue="64"), foreign, report("2017-06-30", totalRevenue=65)], [foreign])
    model = silver.income_statement(staging(spark, (5, raw)))
    assert {(r["report_type"], r["fiscaldateending"], r["total_revenue"]) for r in model.collect()} == {
        ("annual", date(2018, 6, 30), 64),
        ("annual", date(2017, 6, 30), 65),
        ("annual", None, None),
        ("quarterly", None, None),
    }


@pytest.mark.parametrize(("endpoint", "field", "column", "parse", "too_large"), STATEMENTS)
def test_empty_missing_or_unreadable_arrays_give_no_rows(spark, endpoint, field, column, parse, too_large):
    model = silver.MODELS[endpoint.name](
        staging(
            spark,
            (8, document(endpoint)),
            (8, {"symbol": "GNU"}),
            (8, {"symbol": "GNU", endpoint.annual: {"fiscalDateEnding": "2025-12-31"}}),
            (8, "not json"),
            (8, ""),
        )
    )
    assert model.count() == 0


GREATEST, LEAST = 2**63 - 1, -(2**63)


def fitting(number):
    """A whole number as a BIGINT column holds it."""
    return number if number is not None and LEAST <= number <= GREATEST else None


def total(a, b):
    return None if a is None or b is None else fitting(a + b)


def difference(a, b):
    return None if a is None or b is None else fitting(a - b)


def derived(spark, endpoint, names, cases, columns):
    """Derived columns by case; a case gives an amount, or None for one that is not sent, to each name."""
    days = [f"20{10 + i}-02-03" for i in range(len(cases))]
    reports = [
        report(day, **{n: str(v) for n, v in zip(names, case, strict=True) if v is not None})
        for day, case in zip(days, cases, strict=True)
    ]
    model = silver.MODELS[endpoint.name](staging(spark, (6, document(endpoint, reports))))
    found = {r["fiscaldateending_raw"]: tuple(r[c] for c in columns) for r in model.collect()}
    return [found[day] for day in days]


def test_ebitda_is_reported_or_summed(spark):
    cases = [(None, 31, 7), (64, 31, 7), (64, None, None), (None, 31, None), (None, None, 7), (None, GREATEST, 3), (0, 1, 1), (None, LEAST, -1), (None, LEAST, GREATEST)]
    expected = [(e if e is not None else total(x, d),) for e, x, d in cases]
    assert derived(spark, INCOME, ["ebitda", "ebit", "depreciationAndAmortization"], cases, ["ebitda_calc"]) == expected


def test_debt_is_reported_or_summed_and_net_of_cash(spark):
    names = ["shortLongTermDebtTotal", "longTermDebt", "shortTermDebt", "cashAndCashEquivalentsAtCarryingValue"]
    cases = [(None, 41, 9, 13), (77, 41, 9, 13), (77, None, None, None), (None, 41, None, 13), (None, GREATEST, 2, 13), (LEAST, None, None, 5), (0, None, None, 13), (None, -4, 4, 0)]
    expected = []
    for reported, long, short, cash in cases:
        debt = reported if reported is not None else total(long, short)
        expected.append((debt, difference(debt, cash)))
    assert derived(spark, BALANCE, names, cases, ["total_debt", "net_debt"]) == expected


def test_free_cash_flow_is_a_difference(spark):
    cases = [(905, 17), (17, 905), (905, None), (None, 17), (LEAST, 2), (GREATEST, -1), (0, 0)]
    expected = [(difference(*case),) for case in cases]
    assert derived(spark, CASH_FLOW, ["operatingCashflow", "capitalExpenditures"], cases, ["free_cash_flow"]) == expected


def test_only_quarters_have_an_announcement(spark):
    """All fields are sent for both frequencies; the annual row has no announcement date and time."""
    every = {"fiscalDateEnding": "2022-05-31", "reportedEPS": "-0.375", "reportedDate": "2022-07-04", "reportTime": "noon"}
    every |= {"estimatedEPS": "0.5", "surprise": "-0.875", "surprisePercentage": "-175"}
    model = silver.earnings(staging(spark, (8, statement("GNU", [every], [every], arrays=EARNINGS_ARRAYS))))
    by_kind = {r["report_type"]: r for r in model.collect()}
    announced = ("reported_date", "report_time")
    assert tuple(by_kind["annual"][c] for c in announced) == (None, None)
    assert tuple(by_kind["quarterly"][c] for c in announced) == (date(2022, 7, 4), "noon")
    amounts = ("reported_eps", "estimated_eps", "surprise_percentage")
    assert {tuple(r[c] for c in amounts) for r in by_kind.values()} == {(dec("-0.375"), dec("0.5"), dec("-175"))}


def test_one_overview_per_company(spark):
    snapshots = [
        (2, {"Symbol": "GNU", "PERatio": "14.5", "Sector": "Energy"}),
        (5, {"Symbol": "GNU", "PERatio": "0", "Sector": "N/A", "MarketCapitalization": 123456789012}),
        (4, {"Symbol": "GNU", "PERatio": "99"}),
        (4, {"Symbol": "EMU", "EPS": "-"}),
    ]
    model = {r["symbol"]: r for r in silver.overview(staging(spark, *snapshots)).collect()}
    assert set(model) == {"GNU", "EMU"}
    newest = model["GNU"]
    # a zero is a value, and a text field keeps what a number field would call missing
    assert (newest["pe_ratio"], newest["sector"], newest["market_capitalization"]) == (dec("0"), "N/A", 123456789012)
    assert newest["ingest_date"] == date(2026, 9, 5) and model["EMU"]["eps"] is None


def test_overview_numbers_that_cannot_be_read(spark):
    numbers = [f for f in OVERVIEW.fields if not f.is_text]
    unreadable = ["N/A", "-", "", "None", "x1", str(2**63) + "0" * 30]
    sent = {f.source: unreadable[i % len(unreadable)] for i, f in enumerate(numbers)}
    row = silver.overview(staging(spark, (1, {"Symbol": "GNU", **sent}))).first()
    assert {row[f.column] for f in numbers} == {None}


@pytest.mark.parametrize("endpoint", list(ENDPOINTS))
@pytest.mark.parametrize("as_text", [True, False])
def test_every_field_reaches_its_column(spark, endpoint, as_text):
    spec = ENDPOINTS[endpoint]
    sent, expected = {}, {}
    for i, field in enumerate(spec.fields):
        if field.is_text:
            sent[field.source] = expected[field.column] = f"sample {field.source}"
        elif "decimal" in field.dtype.simpleString():
            sent[field.source] = f"{i}.125" if as_text else i + 0.125
            expected[field.column] = dec(f"{i}.125")
        else:
            sent[field.source] = str(1000 + i) if as_text else 1000 + i
            expected[field.column] = 1000 + i
    if spec is OVERVIEW:
        raw = {"Symbol": "GNU", **sent}
    else:
        raw = document(spec, [report("2025-12-31", **sent)], [report("2025-12-31", **sent)])
    found = silver.MODELS[endpoint](staging(spark, (8, raw))).collect()
    assert len(found) == (1 if spec is OVERVIEW else 2)
    for row in found:
        assert row["symbol"] == "GNU"
        assert {c: row[c] for c in expected} == expected


def test_narrow_and_wide_models_keep_the_same_copy(spark):
    """Copies of one day are tied; the choice may not depend on which columns are read."""
    rng = random.Random(7)
    documents = [
        (8, document(INCOME, [report("2025-12-31", totalRevenue=str(rng.randrange(10**6)), netIncome=str(i))]))
        for i in range(20)
    ]
    columns = ["symbol", "total_revenue", "net_income"]
    wide = silver.income_statement(staging(spark, *documents)).select(*columns)
    rng.shuffle(documents)
    narrow = silver.income_statement(staging(spark, *documents), columns)
    assert rows(wide, *columns) == rows(narrow, *columns)


def test_null_dates_form_one_group(spark):
    reports = [report("broken", totalRevenue="1"), report("also broken", totalRevenue="2")]
    model = silver.income_statement(staging(spark, (8, document(INCOME, reports))))
    assert rows(model, "fiscaldateending", "total_revenue") == [(None, 1)]


def test_nested_values_are_not_text(spark):
    raw = document(INCOME, [{"fiscalDateEnding": "2025-12-31", "reportedCurrency": {"a": 1}, "totalRevenue": [5]}])
    model = silver.income_statement(staging(spark, (8, raw)))
    assert rows(model, "fiscaldateending", "reportedcurrency", "total_revenue") == [(date(2025, 12, 31), None, None)]
