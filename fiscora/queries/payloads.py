"""Company payloads derived from the star-schema tables.

A supplier stands for a company (``SUP<key>``), an order quarter or year for a
fiscal period. Amounts are exact integers. Each field is given twice: as the text
(or number) the payload carries, and as the typed value Silver must show, both as
plain SQL over the period columns ``k, n, qty, cents, revenue, tax, b``. The
second form feeds the oracle, which never touches JSON.

Planted on purpose: sentinels, unreadable and oversized numbers, one broken date,
a restatement (``b``) on the second ingestion day, and companions with gaps.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import (
    ANNUAL,
    BALANCE,
    CASH_FLOW,
    EARNINGS,
    INCOME,
    OVERVIEW,
    QUARTERLY,
    Endpoint,
)

# Ingestion days of the derived lake.
DAYS = ("2026-09-07", "2026-09-08")
MONEY_SUMS = ("n", "qty", "cents", "revenue", "tax")

# source field -> (payload expression, expected value); others follow a rule below.
INCOME_VALUES = {
    "totalRevenue": (
        "CASE WHEN n % 13 = 0 THEN 'bad-number' WHEN n % 17 = 0 THEN '9223372036854775808' "
        "WHEN n % 11 = 0 THEN element_at(array('None', '-', 'N/A', ''), CAST(n % 4 AS INT) + 1) "
        "ELSE CAST(revenue + b AS STRING) END",
        "CASE WHEN n % 13 = 0 OR n % 17 = 0 OR n % 11 = 0 THEN NULL ELSE revenue + b END",
    ),
    "netIncome": ("tax - n * 50000", "tax - n * 50000"),
    "ebit": ("CAST(tax * 2 AS STRING)", "tax * 2"),
    "depreciationAndAmortization": (
        "CASE WHEN n % 6 <> 0 THEN CAST(n * 1000 AS STRING) END",
        "CASE WHEN n % 6 <> 0 THEN n * 1000 END",
    ),
    "ebitda": (
        "CASE WHEN n % 3 = 0 THEN 'None' ELSE CAST(tax * 2 + n * 1000 AS STRING) END",
        "CASE WHEN n % 3 <> 0 THEN tax * 2 + n * 1000 END",
    ),
}
CLEAN_REVENUE = {"totalRevenue": ("CAST(revenue + b AS STRING)", "revenue + b")}
BALANCE_VALUES = {
    "totalAssets": ("CAST(cents * 2 + b AS STRING)", "cents * 2 + b"),
    "totalShareholderEquity": ("CAST(cents AS STRING)", "cents"),
    "totalCurrentAssets": ("CAST(qty * 10000 AS STRING)", "qty * 10000"),
    "totalCurrentLiabilities": (
        "CASE WHEN n % 5 = 0 THEN '0' ELSE CAST(qty * 7000 AS STRING) END",
        "CASE WHEN n % 5 = 0 THEN 0 ELSE qty * 7000 END",
    ),
    "shortLongTermDebtTotal": (
        "CASE WHEN n % 4 = 0 THEN '-' ELSE CAST(tax AS STRING) END",
        "CASE WHEN n % 4 <> 0 THEN tax END",
    ),
    "longTermDebt": ("CAST((tax - tax % 2) / 2 AS BIGINT)", "CAST((tax - tax % 2) / 2 AS BIGINT)"),
    "shortTermDebt": (
        "CASE WHEN n % 8 = 0 THEN 'N/A' ELSE CAST(n * 100 AS STRING) END",
        "CASE WHEN n % 8 <> 0 THEN n * 100 END",
    ),
    "cashAndCashEquivalentsAtCarryingValue": ("CAST(n * 5000 AS STRING)", "n * 5000"),
}
CASH_FLOW_VALUES = {
    "operatingCashflow": ("CAST(tax * 2 AS STRING)", "tax * 2"),
    "capitalExpenditures": (
        "CASE WHEN n % 7 = 0 THEN '-' ELSE CAST(n * 9000 AS STRING) END",
        "CASE WHEN n % 7 <> 0 THEN n * 9000 END",
    ),
    "netIncome": ("CAST(tax + b AS STRING)", "tax + b"),
}
EARNINGS_VALUES = {
    "reportedEPS": ("CAST(n * 0.25 AS STRING)", "n * 0.25"),
    # an annual report has none of the following
    "estimatedEPS": (
        "CASE WHEN report_type = 'quarterly' THEN CAST(n * 0.5 + b AS STRING) END",
        "CASE WHEN report_type = 'quarterly' THEN n * 0.5 + b END",
    ),
    "surprise": (
        "CASE WHEN report_type = 'annual' THEN NULL WHEN n % 3 = 0 THEN 'None' "
        "ELSE CAST(n * -0.0625 AS STRING) END",
        "CASE WHEN report_type = 'quarterly' AND n % 3 <> 0 THEN n * -0.0625 END",
    ),
    "surprisePercentage": (
        "CASE WHEN report_type = 'quarterly' THEN CAST(n * 0.125 AS STRING) END",
        "CASE WHEN report_type = 'quarterly' THEN n * 0.125 END",
    ),
}
OVERVIEW_VALUES = {
    "Name": ("s_name", "s_name"),
    "Sector": ("n_name", "n_name"),
    "Country": ("r_name", "r_name"),
    # text fields keep a sentinel as it is
    "Exchange": ("CASE WHEN k % 3 = 0 THEN 'N/A' ELSE 'NYSE' END", "CASE WHEN k % 3 = 0 THEN 'N/A' ELSE 'NYSE' END"),
    "LatestQuarter": ("'2026-06-30'", "'2026-06-30'"),
    "MarketCapitalization": ("CAST(k * 1000000 + b AS STRING)", "k * 1000000 + b"),
    "PERatio": (
        "CASE WHEN k % 4 = 0 THEN 'None' ELSE CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS STRING) END",
        "CASE WHEN k % 4 <> 0 THEN CAST(s_acctbal AS DECIMAL(12, 2)) END",
    ),
}
VALUES = {
    INCOME.name: INCOME_VALUES,
    BALANCE.name: BALANCE_VALUES,
    CASH_FLOW.name: CASH_FLOW_VALUES,
    EARNINGS.name: EARNINGS_VALUES,
    OVERVIEW.name: OVERVIEW_VALUES,
}
# A companion period that does not exist.
MISSING_PERIOD = {CASH_FLOW.name: "n % 10 = 0"}
NO_OVERVIEW = "k % 9 = 0"
BROKEN_DATE = "k % 25 = 0"


def field_values(endpoint: Endpoint, clean: bool = False) -> dict[str, tuple[str, str]]:
    """Payload expression and expected value of every field of an endpoint."""
    special = dict(VALUES[endpoint.name])
    if clean and endpoint is INCOME:
        special.update(CLEAN_REVENUE)
    values = {}
    for i, field in enumerate(endpoint.fields):
        if field.source in special:
            values[field.source] = special[field.source]
        elif endpoint is OVERVIEW and field.is_text:
            text = f"concat('{field.source} ', CAST(k AS STRING))"
            values[field.source] = (text, text.replace("STRING", "VARCHAR"))
        elif endpoint is OVERVIEW:
            step = "0.125" if str(field.dtype.simpleString()).startswith("decimal") else "1000"
            values[field.source] = (f"CAST(k * {step} + {i} AS STRING)", f"k * {step} + {i}")
        else:
            values[field.source] = (f"CAST(n * 1000 + {i} AS STRING)", f"n * 1000 + {i}")
    return values


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact integer sums per supplier and fiscal period: ``k, report_type, period_end`` + sums.

    The order-level join is aggregated to quarters before anything else; years are
    summed from quarters.
    """
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_suppkey").alias("k"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("d"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("t"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    day = F.col("o_orderdate").cast("date")
    quarter_end = F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    order = table(spark, sf_dir, "orders").select("o_orderkey", quarter_end.alias("period_end"))
    quarters = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("k", "period_end")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("q").alias("qty"),
            F.sum("c").alias("cents"),
            F.sum(F.col("c") * (100 - F.col("d"))).alias("revenue"),
            F.sum(F.col("c") * F.col("t")).alias("tax"),
        )
    )
    both = quarters.select(
        "k",
        F.inline(
            F.array(
                F.struct(F.lit(QUARTERLY).alias("report_type"), F.col("period_end")),
                F.struct(
                    F.lit(ANNUAL).alias("report_type"),
                    F.make_date(F.year("period_end"), F.lit(12), F.lit(31)).alias("period_end"),
                ),
            )
        ),
        *MONEY_SUMS,
    )
    return both.groupBy("k", "report_type", "period_end").agg(*(F.sum(s).alias(s) for s in MONEY_SUMS))


def with_days(rows: DataFrame) -> DataFrame:
    """One copy per ingestion day: every company on the first, even keys again on the second.

    The first copy of an even key differs by ``b = 1``: the second restates it.
    """
    days = F.explode(F.array(*(F.to_date(F.lit(d)) for d in DAYS)))
    copies = rows.withColumn("ingest_date", days)
    second = F.col("ingest_date") == F.lit(DAYS[1]).cast("date")
    even = F.col("k") % 2 == 0
    return copies.where(~second | even).withColumn("b", (even & ~second).cast("bigint"))


def _symbol() -> Column:
    return F.concat(F.lit("SUP"), F.col("k").cast("string"))


def _of_report(sql: str) -> str:
    """An expression over the columns of a period, for the period ``p`` of a gathered document."""
    return re.sub(rf"\b({'|'.join(('report_type', 'period_end', *MONEY_SUMS))})\b", r"p.\1", sql)


def _reports(endpoint: Endpoint, periods_column: str, clean: bool) -> Column:
    """Gathered periods as reports, the newest first."""
    fields = {"fiscalDateEnding": "date_format(period_end, 'yyyy-MM-dd')"}
    if endpoint.currency_required:
        fields["reportedCurrency"] = "'USD'"
    else:
        fields["reportedDate"] = "date_format(date_add(period_end, 30), 'yyyy-MM-dd')"
        fields["reportTime"] = "'post-market'"
    values = field_values(endpoint, clean)
    fields |= {f.source: values[f.source][0] for f in endpoint.fields}
    members = ", ".join(f"'{name}', {_of_report(sql)}" for name, sql in fields.items())
    return F.expr(f"sort_array(transform({periods_column}, p -> named_struct({members})), false)")


def statement_payloads(rows: DataFrame, endpoint: Endpoint, clean: bool = False) -> DataFrame:
    """``k, ingest_date, raw_data``: one document per supplier and day.

    ``rows`` are periods. A document gathers the periods of one supplier, a number
    bounded by the calendar. Only the narrow periods are shuffled, once for all days; the
    reports with their many texts are written where they end up. Keys divisible by four send no
    quarterly reports on the second day. ``clean`` leaves out what the contract would reject.
    """
    if endpoint.name in MISSING_PERIOD:
        rows = rows.where(f"NOT ({MISSING_PERIOD[endpoint.name]})")
    period = F.struct("report_type", "period_end", *MONEY_SUMS)
    gathered = with_days(rows.groupBy("k").agg(F.collect_list(period).alias("periods")))
    annual_only = (F.col("ingest_date") == F.lit(DAYS[1]).cast("date")) & (F.col("k") % 4 == 0)

    def of_kind(kind: str) -> Column:
        return F.expr(f"filter(periods, p -> p.report_type = '{kind}')")

    sent = gathered.select(
        "k",
        "ingest_date",
        "b",
        of_kind(ANNUAL).alias("annual"),
        F.when(annual_only, F.slice("periods", 1, 0)).otherwise(of_kind(QUARTERLY)).alias("quarterly"),
    ).where((F.size("annual") > 0) | (F.size("quarterly") > 0))
    documents = sent.withColumns({kind: _reports(endpoint, kind, clean) for kind in ("annual", "quarterly")})
    if endpoint is INCOME and not clean:
        null_report = [F.lit("broken-date").alias("fiscalDateEnding")]
        for f in documents.schema["quarterly"].dataType.elementType.fields[1:]:
            value = F.lit("42") if f.name == "totalRevenue" else F.lit(None)
            null_report.append(value.cast(f.dataType).alias(f.name))
        broken = F.array(F.struct(*null_report))
        has_one = F.expr(BROKEN_DATE) & (F.size("quarterly") > 0)
        # none or one report at the end: the reports before it are written once
        documents = documents.withColumn(
            "quarterly", F.concat("quarterly", F.when(has_one, broken).otherwise(F.slice(broken, 1, 0)))
        )
    body = F.struct(
        _symbol().alias("symbol"),
        F.col("annual").alias(endpoint.annual),
        F.col("quarterly").alias(endpoint.quarterly),
    )
    return documents.select("k", "ingest_date", F.to_json(body).alias("raw_data"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation and region names."""
    return (
        table(spark, sf_dir, "supplier")
        .withColumnRenamed("s_suppkey", "k")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("k", "s_name", "s_acctbal", "n_name", "r_name")
    )


def overview_payloads(rows: DataFrame) -> DataFrame:
    """``k, ingest_date, raw_data``: one flat document per supplier and day."""
    values = field_values(OVERVIEW)
    body = F.struct(
        _symbol().alias("Symbol"), *(F.expr(values[f.source][0]).alias(f.source) for f in OVERVIEW.fields)
    )
    return (
        with_days(rows)
        .where(f"NOT ({NO_OVERVIEW})")
        .select("k", "ingest_date", F.to_json(body).alias("raw_data"))
    )


def first_number(endpoint: Endpoint) -> str:
    return next(f.source for f in endpoint.fields if not f.is_text)


def plant_contract_faults(payloads: DataFrame, endpoint: Endpoint) -> DataFrame:
    """Break some documents by ``k % 20``: each remainder gets one kind of fault."""
    raw = F.col("raw_data")
    fault = F.col("k") % 20
    no_key = rf'^\{{"{endpoint.key}":"[^"]*",'
    first_date = r'^(.*?"fiscalDateEnding":)"[^"]*"'
    number = rf'^(.*?"{first_number(endpoint)}":)"[^"]*"'
    broken = (
        F.when(fault == 1, F.regexp_replace(raw, r"\}$", ',"newEnvelopeField":1}'))
        .when(fault == 2, F.regexp_replace(raw, no_key, "{"))
        .when(fault == 3, F.regexp_replace(raw, first_date, '$1"2025-13-45"'))
        .when(fault == 4, F.regexp_replace(raw, number, '$1"bad-number"'))
        .when(fault == 5, F.lit('{"Note":"too many calls at once"}'))
        .when(fault == 6, F.lit('{"Information":"the daily RATE LIMIT is used up"}'))
        .when(fault == 7, F.lit('{"Error Message":"no such function"}'))
        .when(fault == 8, F.lit("{}"))
        .when(fault == 9, F.substring(raw, 1, 20))
        .when(fault == 10, F.lit('{"Information":"not part of this plan"}'))
        # both invalid and with an extra field: invalid wins
        .when(fault == 11, F.regexp_replace(raw, no_key, '{"newEnvelopeField":1,'))
        .otherwise(raw)
    )
    return payloads.withColumn("raw_data", broken)


def event_attempts(spark: SparkSession, sf_dir: str, endpoints: list[str]) -> DataFrame:
    """Events read as source calls: a day is a run, users share the endpoints."""
    events = table(spark, sf_dir, "events")
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_id") % 10 == 3, "rate_limit_daily")
        .when(F.col("event_id") % 10 == 6, "rate_limit_transient")
        .otherwise("success")
    )
    names = F.array(*(F.lit(e) for e in endpoints))
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.element_at(names, (F.col("user_id") % len(endpoints) + 1).cast("int")).alias("endpoint"),
        F.col("user_id").cast("string").alias("symbol"),
        (F.col("event_id") % 3 + 1).cast("int").alias("attempt"),
        status.alias("status"),
    )
