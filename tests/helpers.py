"""Small builders shared by the tests."""

from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

from fiscora.sources.bronze import STAGING_SCHEMA


def staging(spark, *documents):
    """Staging rows from ``(day of September 2026, document)``."""
    rows = [(d if isinstance(d, str) else json.dumps(d), 2026, 9, day) for day, d in documents]
    return spark.createDataFrame(rows, STAGING_SCHEMA)


def payloads(spark, *documents):
    """Documents before ingest, as ``raw_data, ingest_date``."""
    rows = [(d if isinstance(d, str) else json.dumps(d), date(2026, 9, day)) for day, d in documents]
    return spark.createDataFrame(rows, "raw_data string, ingest_date date")


def report(day, **fields):
    return {"fiscalDateEnding": day, "reportedCurrency": "USD", **fields}


def statement(symbol, annual=(), quarterly=(), arrays=("annualReports", "quarterlyReports"), **extra):
    return {"symbol": symbol, arrays[0]: list(annual), arrays[1]: list(quarterly), **extra}


EARNINGS_ARRAYS = ("annualEarnings", "quarterlyEarnings")


def rows(frame, *columns):
    """Collected rows of the columns, sorted, as tuples."""
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def dec(text):
    return Decimal(text).quantize(Decimal("0.000000001"))
