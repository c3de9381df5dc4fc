"""Silver and Gold against plain Python on random documents with one hot company."""

import json
import random
import re
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from fiscora.catalog import ENDPOINTS, GOLD_SCHEMA
from fiscora.plans import gold
from fiscora.sources.bronze import STAGING_SCHEMA
from helpers import report, statement

START = date(2026, 8, 1)
AMOUNTS = ["None", "-", "N/A", "", "bad", "9223372036854775807", "9223372036854775808", "0", "-5", 7, 12.5, None]
DAYS = ["2024-12-31", "2025-03-31", "2025-06-30", "2025-09-30", "2025-12-31", "broken", "2025-02-30", "2023-12-31"]
FIELDS = {
    "income_statement": ["totalRevenue", "netIncome", "ebitda", "ebit", "depreciationAndAmortization"],
    "balance_sheet": [
        "totalShareholderEquity",
        "totalCurrentAssets",
        "totalCurrentLiabilities",
        "shortLongTermDebtTotal",
        "longTermDebt",
        "shortTermDebt",
        "cashAndCashEquivalentsAtCarryingValue",
    ],
    "cash_flow": ["operatingCashflow", "capitalExpenditures"],
    "earnings": ["surprisePercentage"],
}


def documents(rng, name):
    """One document per company and day, so that no two copies of a period are tied across documents."""
    endpoint, found = ENDPOINTS[name], {}
    for i in range(90):
        symbol = "HOT" if i % 3 == 0 else f"S{rng.randrange(8)}"
        day = rng.randrange(30)
        if name == "overview":
            sector, price = rng.choice(["Tech", "None"]), rng.choice(AMOUNTS)
            found[symbol, day] = {"Symbol": symbol, "Sector": sector, "PERatio": price}
            continue

        def amount():
            return rng.choice(AMOUNTS) if rng.random() < 0.3 else str(rng.randrange(-(10**6), 10**6))

        arrays = [
            [
                report(rng.choice(DAYS), **{f: amount() for f in FIELDS[name] if rng.random() < 0.9})
                for _ in range(rng.randrange(5))
            ]
            for _ in range(2)
        ]
        found[symbol, day] = statement(symbol, *arrays, arrays=endpoint.arrays)
    return [(START + timedelta(days=day), document) for (_, day), document in found.items()]


def staging(spark, docs):
    rows = [(json.dumps(d), day.year, day.month, day.day) for day, d in docs]
    return spark.createDataFrame(rows, STAGING_SCHEMA).repartition(5)


def integer(value):
    text = "" if value is None or isinstance(value, float) else str(value)
    number = int(text) if re.fullmatch(r"[+-]?\d+", text) else None
    return number if number is not None and -(2**63) <= number < 2**63 else None


def numeric(value):
    text = "" if value is None else str(value)
    return Decimal(text) if re.fullmatch(r"[+-]?\d+(\.\d+)?", text) else None


def day_of(text):
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def latest(name, docs):
    """Periods by key: the newest document wins, the first place inside it."""
    endpoint, best = ENDPOINTS[name], {}
    for day, document in docs:
        for kind, array in zip(("annual", "quarterly"), endpoint.arrays, strict=True):
            for place, item in enumerate(document[array]):
                key = (document["symbol"], day_of(item["fiscalDateEnding"]), kind)
                rank = (day, -place)
                if key not in best or rank > best[key][0]:
                    best[key] = (rank, item, day)
    return {key: (item, day) for key, (_, item, day) in best.items()}


def fits(number):
    return number if number is not None and -(2**63) <= number < 2**63 else None


def plus(a, b):
    return None if a is None or b is None else fits(a + b)


def minus(a, b):
    return None if a is None or b is None else fits(a - b)


def ratio(a, b):
    if a is None or not b:
        return None
    return (Decimal(a) / Decimal(b)).quantize(Decimal("0.000000001"), rounding=ROUND_HALF_UP)


def expected_gold(docs):
    income, balance, cash, earnings = (
        latest(n, docs[n]) for n in ("income_statement", "balance_sheet", "cash_flow", "earnings")
    )
    snapshots = {}
    for day, document in sorted(docs["overview"], key=lambda d: d[0]):
        snapshots[document["Symbol"]] = (day, document)

    histories = {}
    for (symbol, period, kind), (item, _) in income.items():
        histories.setdefault((symbol, kind), []).append((period, integer(item.get("totalRevenue"))))
    result = []
    for key, (item, day) in income.items():
        symbol, period, kind = key
        history = sorted(histories[symbol, kind], key=lambda h: (h[0] is not None, h[0] or date.min))
        place = [p for p, _ in history].index(period) - (4 if kind == "quarterly" else 1)
        prior = history[place][1] if place >= 0 else None
        # a NULL date matches nothing
        b, c, e = ({} if period is None else f.get(key, ({},))[0] for f in (balance, cash, earnings))
        revenue, net = integer(item.get("totalRevenue")), integer(item.get("netIncome"))
        ebitda = integer(item.get("ebitda"))
        if ebitda is None:
            ebitda = plus(integer(item.get("ebit")), integer(item.get("depreciationAndAmortization")))
        debt = integer(b.get("shortLongTermDebtTotal"))
        if debt is None:
            debt = plus(integer(b.get("longTermDebt")), integer(b.get("shortTermDebt")))
        net_debt = minus(debt, integer(b.get("cashAndCashEquivalentsAtCarryingValue")))
        equity, assets, liabilities = (
            integer(b.get(n)) for n in ("totalShareholderEquity", "totalCurrentAssets", "totalCurrentLiabilities")
        )
        operating = integer(c.get("operatingCashflow"))
        snapshot_day, snapshot = snapshots.get(symbol, (None, {}))
        change = None if revenue is None or prior is None else revenue - prior
        result.append(
            {
                "symbol": symbol,
                "fiscaldateending": period,
                "report_type": kind,
                "reportedcurrency": "USD",
                "ingest_date": day,
                "sector": snapshot.get("Sector"),
                "industry": None,
                "country": None,
                "exchange": None,
                "overview_snapshot_date": snapshot_day,
                "total_revenue": revenue,
                "net_income": net,
                "ebitda_calc": ebitda,
                "total_shareholder_equity": equity,
                "total_current_assets": assets,
                "total_current_liabilities": liabilities,
                "net_debt": net_debt,
                "operating_cashflow": operating,
                "roe": ratio(net, equity),
                "net_margin": ratio(net, revenue),
                "ebitda_margin": ratio(ebitda, revenue),
                "net_debt_to_ebitda": ratio(net_debt, ebitda),
                "current_ratio": ratio(assets, liabilities),
                "free_cash_flow": minus(operating, integer(c.get("capitalExpenditures"))),
                "quality_of_earnings": ratio(operating, net),
                "revenue_yoy_growth": ratio(change, prior),
                "earnings_surprise_pct": numeric(e.get("surprisePercentage")),
                "pe_ratio": numeric(snapshot.get("PERatio")),
                "ev_to_ebitda": None,
            }
        )
    return result


@pytest.mark.parametrize("seed", range(3))
def test_gold_from_random_bronze(spark, seed):
    rng = random.Random(seed)
    docs = {name: documents(rng, name) for name in ENDPOINTS}
    found = gold.gold_from_bronze({name: staging(spark, rows) for name, rows in docs.items()}).collect()
    names = GOLD_SCHEMA.names

    def in_order(records):
        return sorted((tuple(r[n] for n in names) for r in records), key=lambda r: repr(r[:3]))

    expected = in_order(expected_gold(docs))
    assert len(expected) > 60
    assert in_order(r.asDict() for r in found) == expected
