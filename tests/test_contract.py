import json
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from fiscora.catalog import BALANCE, CASH_FLOW, EARNINGS, ENDPOINTS, INCOME, OVERVIEW
from fiscora.operators import contract
from helpers import EARNINGS_ARRAYS, payloads, report, statement

NO_ANNUAL = "annualReports: missing or not a list of reports"
MINIMAL = {
    "overview": {"Symbol": "ORB", "AssetType": "Fund", "MarketCapitalization": 4711, "PERatio": 12.25},
    "income_statement": statement("ORB", [report("2019-05-31", totalRevenue=311)]),
    "balance_sheet": statement("ORB", [report("2019-05-31")]),
    "cash_flow": statement("ORB", [report("2019-05-31", operatingCashflow=27)]),
    "earnings": statement("ORB", arrays=EARNINGS_ARRAYS),
}


def check(spark, endpoint, *documents):
    routed = contract.route(payloads(spark, *((8, d) for d in documents)), endpoint)
    return routed.select("route", "payload_class", "violations", "extra_fields", "fiscal_date", "n_records").collect()


def verdict(spark, endpoint, document):
    row = check(spark, endpoint, document)[0]
    return row["route"], list(row["violations"])


@pytest.mark.parametrize("endpoint", list(ENDPOINTS))
def test_minimal_documents_are_accepted(spark, endpoint):
    assert verdict(spark, ENDPOINTS[endpoint], MINIMAL[endpoint]) == ("accepted", [])


@pytest.mark.parametrize("endpoint", list(ENDPOINTS))
def test_unknown_envelope_field_goes_to_quarantine(spark, endpoint):
    row = check(spark, ENDPOINTS[endpoint], {**MINIMAL[endpoint], "surplusField": 123})[0]
    assert row["route"] == "quarantine"
    assert row["extra_fields"] == ["surplusField"]


def test_unknown_report_field_is_allowed(spark):
    document = statement("ORB", [report("2019-05-31", newField="x")])
    assert verdict(spark, INCOME, document) == ("accepted", [])


def test_invalid_beats_extra(spark):
    route, found = verdict(spark, OVERVIEW, {"surplusField": 1, "Name": "x"})
    assert (route, found) == ("rejected", ["Symbol: missing or not a string"])


@pytest.mark.parametrize(
    ("raw", "kind"),
    [
        ('{"Note":"slow down"}', "rate_limit"),
        ('{"Information":"standard API RATE LIMIT is 25 requests per day"}', "daily_limit"),
        ('{"Information":"not for this plan"}', "access_denied"),
        ('{"Error Message":"no such function"}', "invalid_request"),
        ('{"Note":"x","Information":"rate limit","Error Message":"y"}', "rate_limit"),
        ("{}", "no_data"),
        ("", "malformed"),
        ('{"symbol":"ORB","annualReports":[{', "malformed"),
        ("[1]", "malformed"),
    ],
)
def test_payload_classes(spark, raw, kind):
    row = check(spark, INCOME, raw)[0]
    assert (row["route"], row["payload_class"]) == ("rejected", kind)


@pytest.mark.parametrize(
    ("document", "message"),
    [
        ({"annualReports": [], "quarterlyReports": []}, "symbol: missing or not a string"),
        (statement(5), "symbol: missing or not a string"),
        ({"symbol": "A", "annualReports": []}, "quarterlyReports: missing or not a list of reports"),
        ({"symbol": "A", "annualReports": None, "quarterlyReports": []}, NO_ANNUAL),
        ({"symbol": "A", "annualReports": {}, "quarterlyReports": []}, NO_ANNUAL),
        (statement("A", [{"reportedCurrency": "USD"}]), "annualReports.fiscalDateEnding: not a date"),
        (statement("A", [report("2023-02-30")]), "annualReports.fiscalDateEnding: not a date"),
        (statement("A", [report("2023-9-30")]), "annualReports.fiscalDateEnding: not a date"),
        (statement("A", [report(20230930)]), "annualReports.fiscalDateEnding: not a date"),
        (statement("A", [], [{"fiscalDateEnding": "2019-05-31"}]), "quarterlyReports.reportedCurrency: not a string"),
        (statement("A", [report("2019-05-31", ebit="1.5")]), "annualReports.ebit: not a number"),
        (statement("A", [report("2019-05-31", ebit="none")]), "annualReports.ebit: not a number"),
        (statement("A", [report("2019-05-31", ebit=[1])]), "annualReports.ebit: not a number"),
        (statement("A", [report("2019-05-31", ebit=True)]), "annualReports.ebit: not a number"),
    ],
)
def test_statement_violations(spark, document, message):
    assert verdict(spark, INCOME, document) == ("rejected", [message])


@pytest.mark.parametrize(
    "value", ["100", 100, -5, "-5", "12.0", 12.0, "None", "-", "", "N/A", None, "9223372036854775808", " 7 ", "+7"]
)
def test_accepted_amounts(spark, value):
    assert verdict(spark, CASH_FLOW, statement("A", [report("2019-05-31", netIncome=value)])) == ("accepted", [])


@pytest.mark.parametrize(
    ("field", "value", "ok"),
    [
        ("PERatio", "1.5", True),
        ("PERatio", 1.5, True),
        ("PERatio", "1e3", True),
        ("PERatio", ".5", True),
        ("PERatio", "nan", True),
        ("PERatio", "1.5.5", False),
        ("PERatio", "abc", False),
        ("Name", None, True),
        ("Name", 5, False),
        ("MarketCapitalization", "1.5", False),
        ("52WeekHigh", "x", False),
    ],
)
def test_overview_fields(spark, field, value, ok):
    route, found = verdict(spark, OVERVIEW, {"Symbol": "A", field: value})
    assert (route == "accepted") == ok
    assert ok or found[0].startswith(field)


@pytest.mark.parametrize(
    ("annual", "quarterly", "ok"),
    [
        ({"reportedEPS": "1"}, {"reportedDate": "2024-01-15", "reportTime": "post-market"}, True),
        ({}, {"reportedDate": None}, True),
        ({}, {"reportedDate": "None"}, False),
        ({}, {"reportTime": 5}, False),
        ({}, {"surprise": "x"}, False),
        # not in the annual contract, hence an allowed extra of the report
        ({"surprise": "x", "reportedDate": "soon"}, {}, True),
    ],
)
def test_earnings_contract_by_frequency(spark, annual, quarterly, ok):
    day = {"fiscalDateEnding": "2023-12-31"}
    document = statement("A", [{**day, **annual}], [{**day, **quarterly}], arrays=EARNINGS_ARRAYS)
    assert (verdict(spark, EARNINGS, document)[0] == "accepted") == ok


@pytest.mark.parametrize(
    ("endpoint", "document", "first", "newest"),
    [
        (INCOME, statement("A", [report("2023-12-31")], [report("2024-03-31")]), "2023-12-31", "2024-03-31"),
        (INCOME, statement("A", [], [report("2024-03-31"), report("2024-06-30")]), "2024-03-31", "2024-06-30"),
        (INCOME, statement("A"), None, None),
        (
            EARNINGS,
            statement("A", [report("2023-12-31")], [report("2024-03-31")], arrays=EARNINGS_ARRAYS),
            "2024-03-31",
            "2024-03-31",
        ),
        (EARNINGS, statement("A", [report("2023-12-31")], arrays=EARNINGS_ARRAYS), "2023-12-31", "2023-12-31"),
        (OVERVIEW, {"Symbol": "A", "LatestQuarter": "2026-06-30", "FiscalYearEnd": "May"}, "2026-06-30", "2026-06-30"),
        (OVERVIEW, {"Symbol": "A", "LatestQuarter": "", "FiscalYearEnd": "December"}, "December", "December"),
        (OVERVIEW, {"Symbol": "A"}, None, None),
    ],
)
def test_fiscal_probe(spark, endpoint, document, first, newest):
    rows = payloads(spark, (8, document))
    for rule, expected in (("first", first), ("max", newest)):
        assert contract.route(rows, endpoint, rule).first()["fiscal_date"] == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("[1,2,3]", 3),
        ('{"Symbol":"ORB"}', 1),
        ("{}", 1),
        ("[]", 0),
        (None, 0),
        ("nonsense", 0),
        ('{"annual":[1,2],"quarterly":[3,4,5],"name":"[1,2]"}', 5),
        ('{"annual":[]}', 0),
    ],
)
def test_payload_row_count(spark, raw, expected):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(contract.payload_row_count(F.col("raw"))).first()[0] == expected


def test_record_counts_agree(spark):
    """The count taken while routing equals the general one."""
    documents = [MINIMAL["balance_sheet"], statement("A", [report("2019-05-31")], [report("2019-05-31")] * 3), "{}"]
    documents.append({**MINIMAL["balance_sheet"], "more": [1, 2]})
    routed = contract.route(payloads(spark, *((8, d) for d in documents)), BALANCE)
    for row in routed.select("n_records", contract.payload_row_count(F.col("raw_data")).alias("general")).collect():
        assert row["n_records"] == row["general"]


def test_whole_amounts_become_plain_integers(spark):
    raw = (
        '{"symbol":"A","annualReports":[{"reportedCurrency":"\\"netIncome\\": 3.0,","netIncome": "12.0",'
        '"profitLoss":-7.00 ,"changeInInventory":"1.5","dividendPayout":10.05}],"quarterlyReports":[{"netIncome":5.0}]}'
    )
    frame = spark.createDataFrame([(raw,)], "raw string")
    fixed = json.loads(frame.select(contract.plain_integers(F.col("raw"), CASH_FLOW)).first()[0])
    first = fixed["annualReports"][0]
    assert first["netIncome"] == "12" and first["profitLoss"] == -7
    assert first["reportedCurrency"] == '"netIncome": 3.0,'
    assert first["changeInInventory"] == "1.5" and first["dividendPayout"] == 10.05
    assert fixed["quarterlyReports"][0]["netIncome"] == 5 and isinstance(fixed["quarterlyReports"][0]["netIncome"], int)


def test_extraction_date_is_added(spark):
    frame = payloads(spark, (8, '{"symbol":"A","x":{"y":1}} \n'))
    raw = frame.select(contract.stamp_extraction_date(F.col("raw_data"), F.col("ingest_date"))).first()[0]
    assert json.loads(raw) == {"symbol": "A", "x": {"y": 1}, "extraction_date": "2026-09-08"}


def expected_route(endpoint, document):
    """The contract, document by document, in plain Python."""

    def is_number(value, whole):
        if value is None or value in ("None", "-", "", "N/A"):
            return True
        if isinstance(value, bool) or not isinstance(value, (int, float, str)):
            return False
        shape = r"\s*[+-]?\d+(\.0*)?\s*" if whole else r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
        return re.fullmatch(shape, str(value)) is not None

    def is_day(value):
        try:
            return isinstance(value, str) and date.fromisoformat(value).isoformat() == value
        except ValueError:
            return False

    def numbers_hold(owner, names):
        return all(is_number(owner.get(f.source), "long" in f.dtype.typeName()) for f in names if not f.is_text)

    valid = isinstance(document.get(endpoint.key), str)
    if endpoint.is_flat:
        texts = [f.source for f in endpoint.fields if f.is_text]
        valid &= all(document.get(t) is None or isinstance(document[t], str) for t in texts)
        valid &= numbers_hold(document, endpoint.fields)
    for array in endpoint.arrays:
        reports = document.get(array)
        if not isinstance(reports, list):
            valid = False
            continue
        for item in reports:
            valid &= is_day(item.get("fiscalDateEnding"))
            if endpoint.currency_required:
                valid &= isinstance(item.get("reportedCurrency"), str)
            names = endpoint.fields
            if array == endpoint.annual:
                names = [f for f in names if f.source not in endpoint.quarterly_only]
            elif endpoint.quarterly_only:
                valid &= item.get("reportedDate") is None or is_day(item["reportedDate"])
                valid &= item.get("reportTime") is None or isinstance(item["reportTime"], str)
            valid &= numbers_hold(item, names)
    if not valid:
        return "rejected"
    return "quarantine" if set(document) - set(endpoint.envelope) else "accepted"


ODD_VALUES = ["12", 12, -3, "1.5", 1.5, "12.0", 3.0, "None", "-", "", "N/A", None, "abc", True, [], {}, "1e3", " 4 ", "--1"]
ODD_DAYS = ["2025-12-31", "2025-02-30", "2025-1-5", None, 20251231, "", "2024-02-29"]


@pytest.mark.parametrize("name", list(ENDPOINTS))
def test_random_documents_against_plain_python(spark, name):
    endpoint, rng = ENDPOINTS[name], random.Random(name)

    def scalar(field, odd):
        if rng.random() > odd:
            return "text" if field.is_text else rng.choice(["7", 7, "None"])
        return rng.choice(ODD_VALUES)

    def one(odd):
        fields = {f.source: scalar(f, odd) for f in endpoint.fields if rng.random() < 0.4}
        if endpoint.is_flat:
            document = {endpoint.key: "A", **fields}
        else:
            document = {endpoint.key: "A"}
            for array in endpoint.arrays:
                document[array] = [
                    {
                        "fiscalDateEnding": rng.choice(ODD_DAYS) if rng.random() < odd else "2025-12-31",
                        "reportedCurrency": rng.choice(["USD", None, 5]) if rng.random() < odd else "USD",
                        **({"reportedDate": rng.choice(ODD_DAYS)} if rng.random() < odd else {}),
                        **{f.source: scalar(f, odd) for f in endpoint.fields if rng.random() < 0.3},
                    }
                    for _ in range(rng.randrange(3))
                ]
                if rng.random() < odd:
                    document[array] = rng.choice([None, {}, "x"])
        if rng.random() < odd:
            document[endpoint.key] = rng.choice([None, 5, {}])
        if rng.random() < 0.2:
            document["somethingNew"] = rng.choice([1, "x", []])
        return document

    documents = [one(rng.choice([0, 0, 0.02, 0.1])) for _ in range(300)]
    expected = [expected_route(endpoint, d) for d in documents]
    assert len(set(expected)) == 3
    numbered = spark.createDataFrame(
        [(i, json.dumps(d), date(2026, 9, 8)) for i, d in enumerate(documents)],
        "i int, raw_data string, ingest_date date",
    )
    routed = {r["i"]: r for r in contract.route(numbered, endpoint).select("i", "route", "violations").collect()}
    for i, route in enumerate(expected):
        assert routed[i]["route"] == route, (documents[i], routed[i])
        assert bool(routed[i]["violations"]) == (route == "rejected")
