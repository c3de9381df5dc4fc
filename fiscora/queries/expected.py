"""Expected results as DuckDB SQL over the base tables, without any JSON.

Blocks are ``WITH`` entries; ``query`` puts them in front of a final select.
"""

from __future__ import annotations

from fiscora.catalog import (
    BALANCE,
    CASH_FLOW,
    EARNINGS,
    ENDPOINTS,
    GOLD_SCHEMA,
    INCOME,
    OVERVIEW,
    Endpoint,
)
from fiscora.plans.gold import RATIOS
from fiscora.queries.payloads import BROKEN_DATE, MISSING_PERIOD, NO_OVERVIEW, field_values, first_number

DAY7, DAY8 = "DATE '2026-09-07'", "DATE '2026-09-08'"

_SUMS = """count(*) AS n, CAST(sum(q) AS BIGINT) AS qty, CAST(sum(c) AS BIGINT) AS cents,
    CAST(sum(c * (100 - disc)) AS BIGINT) AS revenue, CAST(sum(c * tx) AS BIGINT) AS tax"""

PERIODS = f"""lines AS (
  SELECT l.l_suppkey AS k, CAST(o.o_orderdate AS DATE) AS d, CAST(l.l_quantity AS BIGINT) AS q,
    CAST(round(l.l_extendedprice * 100) AS BIGINT) AS c,
    CAST(round(l.l_discount * 100) AS BIGINT) AS disc, CAST(round(l.l_tax * 100) AS BIGINT) AS tx
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
periods AS (
  SELECT k, 'quarterly' AS report_type,
    last_day(CAST(date_trunc('quarter', d) AS DATE) + INTERVAL 2 MONTH) AS period_end, {_SUMS}
  FROM lines GROUP BY 1, 2, 3
  UNION ALL
  SELECT k, 'annual', make_date(CAST(year(d) AS INTEGER), 12, 31), {_SUMS} FROM lines GROUP BY 1, 2, 3)"""

# every copy of a period that was sent: first day for all, second for even keys
COPIES = f"""copies AS (
  SELECT *, {DAY7} AS ingest_date, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS b FROM periods
  UNION ALL
  SELECT *, {DAY8}, 0 FROM periods
  WHERE k % 2 = 0 AND NOT (k % 4 = 0 AND report_type = 'quarterly'))"""

# the copy that counts
LATEST = f"""latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY k, report_type, period_end ORDER BY ingest_date DESC) AS rn
    FROM copies) WHERE rn = 1)"""

COMPANIES = """companies AS (
  SELECT s_suppkey AS k, s_name, s_acctbal, n_name, r_name FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

BASE = ",\n".join([PERIODS, COPIES, LATEST, COMPANIES])

SYMBOL = "concat('SUP', CAST(k AS VARCHAR))"


def query(select: str, *blocks: str) -> str:
    return "WITH " + ",\n".join([BASE, *blocks]) + "\n" + select


def ratio(top: str, bottom: str) -> str:
    """Exact quotient rounded half up to nine digits, in wide integers."""
    up = f"(CAST(abs({top}) AS HUGEINT) * 2000000000 + abs({bottom}))"
    size = f"({up} // (2 * abs(CAST({bottom} AS HUGEINT))))"
    sign = f"(CASE WHEN ({top} < 0) <> ({bottom} < 0) THEN -1 ELSE 1 END)"
    return (
        f"CASE WHEN {bottom} <> 0 AND {top} IS NOT NULL THEN "
        f"CAST({size} * {sign} AS DECIMAL(28,0)) * CAST(0.000000001 AS DECIMAL(10,9)) END"
    )


_TYPES = {"bigint": "BIGINT", "decimal(38,9)": "DECIMAL(38,9)", "string": "VARCHAR", "date": "DATE"}


def sql_type(endpoint: Endpoint, column: str) -> str:
    return _TYPES[endpoint.column_type(column).simpleString()]


_PARTITION = {
    "partition_year": "CAST(year(ingest_date) AS BIGINT)",
    "partition_month": "CAST(month(ingest_date) AS BIGINT)",
    "partition_day": "CAST(day(ingest_date) AS BIGINT)",
    "ingest_date": "ingest_date",
    "symbol": SYMBOL,
}
_DERIVED = {
    "ebitda_calc": "coalesce(ebitda, ebit + depreciation_and_amortization)",
    "total_debt": "coalesce(short_long_term_debt_total, long_term_debt + short_term_debt)",
    "net_debt": "coalesce(short_long_term_debt_total, long_term_debt + short_term_debt) - cash_and_cash_equivalents",
    "free_cash_flow": "operating_cashflow - capital_expenditures",
}


def _stored(endpoint: Endpoint) -> dict[str, str]:
    """Expression of every stored column of a period row."""
    columns = {
        **_PARTITION,
        "report_type": "report_type",
        "fiscaldateending": "period_end",
        "fiscaldateending_raw": "strftime(period_end, '%Y-%m-%d')",
        "reportedcurrency": "'USD'",
        "reported_date": "CASE WHEN report_type = 'quarterly' THEN CAST(period_end + INTERVAL 30 DAY AS DATE) END",
        "report_time": "CASE WHEN report_type = 'quarterly' THEN 'post-market' END",
    }
    for source, (_, value) in field_values(endpoint).items():
        field = next(f for f in endpoint.fields if f.source == source)
        columns[field.column] = value
    return columns


def _broken(endpoint: Endpoint, column: str) -> str:
    """The same column for the planted report with an unreadable date."""
    known = {
        **_PARTITION,
        "report_type": "'quarterly'",
        "fiscaldateending_raw": "'broken-date'",
        "total_revenue": "42",
    }
    return known.get(column, "NULL")


def statement_rows(endpoint: Endpoint, rows: str = "latest") -> str:
    """Select of Silver rows of a statement, from ``latest`` or ``copies``."""
    stored = _stored(endpoint)
    inner = [c for c in endpoint.columns if c not in _DERIVED]
    where = f"WHERE NOT ({MISSING_PERIOD[endpoint.name]})" if endpoint.name in MISSING_PERIOD else ""

    def cols(values) -> str:
        return ", ".join(f"CAST({values(c)} AS {sql_type(endpoint, c)}) AS {c}" for c in inner)

    body = f"SELECT {cols(stored.__getitem__)} FROM {rows} {where}"
    if endpoint is INCOME:
        sent = f"SELECT DISTINCT k, ingest_date FROM {rows} WHERE report_type = 'quarterly' AND {BROKEN_DATE}"
        body += f" UNION ALL SELECT {cols(lambda c: _broken(endpoint, c))} FROM ({sent})"
    outer = ", ".join(f"CAST({_DERIVED[c]} AS BIGINT) AS {c}" if c in _DERIVED else c for c in endpoint.columns)
    return f"SELECT {outer} FROM ({body})"


def overview_rows() -> str:
    stored = dict(_PARTITION)
    for source, (_, value) in field_values(OVERVIEW).items():
        field = next(f for f in OVERVIEW.fields if f.source == source)
        stored[field.column] = value
    cols = ", ".join(f"CAST({stored[c]} AS {sql_type(OVERVIEW, c)}) AS {c}" for c in OVERVIEW.columns)
    sent = f"SELECT *, CASE WHEN k % 2 = 0 THEN {DAY8} ELSE {DAY7} END AS ingest_date, 0 AS b FROM companies"
    return f"SELECT {cols} FROM ({sent}) WHERE NOT ({NO_OVERVIEW})"


SILVER_ROWS = {
    INCOME.name: statement_rows(INCOME),
    BALANCE.name: statement_rows(BALANCE),
    CASH_FLOW.name: statement_rows(CASH_FLOW),
    EARNINGS.name: statement_rows(EARNINGS),
    OVERVIEW.name: overview_rows(),
}
SILVER = ",\n".join(f"int_{name} AS ({SILVER_ROWS[name]})" for name in ENDPOINTS)

PRIOR = """prior AS (
  SELECT *, CASE report_type WHEN 'quarterly' THEN lag(total_revenue, 4) OVER w
      WHEN 'annual' THEN lag(total_revenue, 1) OVER w END AS prior_revenue
  FROM int_income_statement
  WINDOW w AS (PARTITION BY symbol, report_type ORDER BY fiscaldateending ASC NULLS FIRST))"""

_ON = "{0}.symbol = i.symbol AND {0}.fiscaldateending = i.fiscaldateending AND {0}.report_type = i.report_type"
JOINED = f"""joined AS (
  SELECT i.*, bs.total_shareholder_equity, bs.total_current_assets, bs.total_current_liabilities, bs.net_debt,
    cf.operating_cashflow, cf.free_cash_flow, ea.surprise_percentage AS earnings_surprise_pct,
    ov.sector, ov.industry, ov.country, ov.exchange, ov.ingest_date AS overview_snapshot_date,
    ov.pe_ratio, ov.ev_to_ebitda
  FROM prior i
  LEFT JOIN int_balance_sheet bs ON {_ON.format("bs")}
  LEFT JOIN int_cash_flow cf ON {_ON.format("cf")}
  LEFT JOIN int_earnings ea ON {_ON.format("ea")}
  LEFT JOIN int_overview ov ON ov.symbol = i.symbol)"""


def _gold_columns() -> str:
    computed = {name: ratio(top, bottom) for name, (top, bottom) in RATIOS.items()}
    change = "(CAST(total_revenue AS HUGEINT) - prior_revenue)"
    computed["revenue_yoy_growth"] = ratio(change, "prior_revenue")
    return ", ".join(f"{computed[c]} AS {c}" if c in computed else c for c in GOLD_SCHEMA.names)


GOLD = ",\n".join([SILVER, PRIOR, JOINED, f"gold AS (SELECT {_gold_columns()} FROM joined)"])


def with_silver(select: str) -> str:
    return query(select, SILVER)


def with_gold(select: str) -> str:
    return query(select, GOLD)


# documents sent per endpoint and day, before any fault is planted
DOCUMENTS = f"""documents AS (
  SELECT DISTINCT 'income_statement' AS endpoint, k, ingest_date FROM copies
  UNION ALL SELECT DISTINCT 'balance_sheet', k, ingest_date FROM copies
  UNION ALL SELECT DISTINCT 'earnings', k, ingest_date FROM copies
  UNION ALL SELECT DISTINCT 'cash_flow', k, ingest_date FROM copies WHERE NOT ({MISSING_PERIOD[CASH_FLOW.name]})
  UNION ALL SELECT 'overview', k, {DAY7} FROM companies WHERE NOT ({NO_OVERVIEW})
  UNION ALL SELECT 'overview', k, {DAY8} FROM companies WHERE NOT ({NO_OVERVIEW}) AND k % 2 = 0)"""

PAYLOAD_CLASS = """CASE k % 20 WHEN 5 THEN 'rate_limit' WHEN 6 THEN 'daily_limit' WHEN 7 THEN 'invalid_request'
    WHEN 8 THEN 'no_data' WHEN 9 THEN 'malformed' WHEN 10 THEN 'access_denied' ELSE 'data' END"""


def route_of(endpoint: str, fault: str = "k % 20") -> str:
    """Route of a document with planted faults; a flat one has no fiscal dates and
    a number already missing cannot be spoilt."""
    dates = "FALSE" if endpoint == "overview" else f"{fault} = 3"
    return (
        f"CASE WHEN {fault} BETWEEN 5 AND 11 OR {fault} IN (2, 4) OR {dates} THEN 'rejected' "
        f"WHEN {fault} = 1 THEN 'quarantine' ELSE 'accepted' END"
    )


def reason_of(endpoint: Endpoint) -> str:
    """Reason of a document with planted faults."""
    key, number = endpoint.key, first_number(endpoint)
    where = {True: "", False: f"{endpoint.annual}."}[endpoint.is_flat]
    if endpoint.is_flat:
        number = next(f.source for f in endpoint.fields if not f.is_text)
        date = "NULL"
    else:
        date = f"'{where}fiscalDateEnding: not a date'"
    return f"""CASE k % 20 WHEN 1 THEN 'extra fields: newEnvelopeField'
      WHEN 2 THEN '{key}: missing or not a string' WHEN 11 THEN '{key}: missing or not a string'
      WHEN 3 THEN {date} WHEN 4 THEN '{where}{number}: not a number'
      WHEN 5 THEN 'rate_limit' WHEN 6 THEN 'daily_limit' WHEN 7 THEN 'invalid_request' WHEN 8 THEN 'no_data'
      WHEN 9 THEN 'malformed' WHEN 10 THEN 'access_denied' END"""
