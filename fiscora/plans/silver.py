"""Silver models: parse, type, keep the latest version, derive.

Every model is a lazy DataFrame over Bronze and can be registered as a view.
``columns`` narrows a model to what a consumer reads; the narrowing reaches the
JSON parser, which is where the time goes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import (
    BALANCE,
    CASH_FLOW,
    EARNINGS,
    ENDPOINTS,
    GRAIN,
    INCOME,
    OVERVIEW,
    PARTITION_COLUMNS,
    QUARTERLY,
    Endpoint,
)
from fiscora.functions import first_or_sum, safe_date, safe_integer, safe_numeric, safe_subtract
from fiscora.operators.flatten import DATE_FIELD, TIEBREAK, flatten_document, flatten_reports
from fiscora.operators.latest import latest_ingest

# Columns each derived amount is computed from.
DERIVED_FROM = {
    "ebitda_calc": ("ebitda", "ebit", "depreciation_and_amortization"),
    "total_debt": ("short_long_term_debt_total", "long_term_debt", "short_term_debt"),
    "net_debt": (
        "short_long_term_debt_total",
        "long_term_debt",
        "short_term_debt",
        "cash_and_cash_equivalents",
    ),
    "free_cash_flow": ("operating_cashflow", "capital_expenditures"),
}
_TEXT_COLUMNS = {"reportedcurrency": "reportedCurrency", "report_time": "reportTime"}


def typed(text: Column, dtype: T.DataType) -> Column:
    """A payload scalar in its catalogue type; unreadable text is NULL."""
    if isinstance(dtype, T.LongType):
        return safe_integer(text)
    if isinstance(dtype, T.DecimalType):
        return safe_numeric(text)
    return text


def ebitda_calc() -> Column:
    return first_or_sum(F.col("ebitda"), F.col("ebit"), F.col("depreciation_and_amortization"))


def total_debt() -> Column:
    return first_or_sum(
        F.col("short_long_term_debt_total"), F.col("long_term_debt"), F.col("short_term_debt")
    )


def net_debt() -> Column:
    return safe_subtract(total_debt(), F.col("cash_and_cash_equivalents"))


def free_cash_flow() -> Column:
    return safe_subtract(F.col("operating_cashflow"), F.col("capital_expenditures"))


DERIVED = {
    "ebitda_calc": ebitda_calc,
    "total_debt": total_debt,
    "net_debt": net_debt,
    "free_cash_flow": free_cash_flow,
}


def statement_periods(
    staging: DataFrame, endpoint: Endpoint, columns: Sequence[str] | None = None
) -> DataFrame:
    """Typed reports before deduplication: keys, requested columns, tie-breaks.

    An unreadable fiscal date stays as a NULL-date row beside its raw text. Derived
    amounts need only their own row, so they are computed here: deduplication then
    shuffles them and not what they were computed from.
    """
    columns = list(columns or endpoint.columns)
    needed = dict.fromkeys(columns)
    for derived in columns:
        needed.update(dict.fromkeys(DERIVED_FROM.get(derived, ())))
    fields = [f for f in endpoint.fields if f.column in needed]
    texts = [src for col, src in _TEXT_COLUMNS.items() if col in needed and col in endpoint.columns]
    if "reported_date" in needed:
        texts.append("reportedDate")
    flat = flatten_reports(staging, endpoint, [f.source for f in fields], texts)

    quarterly = F.col("report_type") == QUARTERLY
    keys = (*PARTITION_COLUMNS, *GRAIN, "fiscaldateending_raw")
    out = [F.col(c) for c in (*PARTITION_COLUMNS, "symbol", "report_type")]
    out.append(F.col(DATE_FIELD).alias("fiscaldateending_raw"))
    out.append(safe_date(F.col(DATE_FIELD)).alias("fiscaldateending"))
    if "reportedCurrency" in texts:
        out.append(F.col("reportedCurrency").alias("reportedcurrency"))
    # annual earnings have no announcement, whatever the payload says
    if "reportedDate" in texts:
        out.append(F.when(quarterly, safe_date(F.col("reportedDate"))).alias("reported_date"))
    if "reportTime" in texts:
        out.append(F.when(quarterly, F.col("reportTime")).alias("report_time"))
    out += [typed(F.col(f.source), f.dtype).alias(f.column) for f in fields]
    rows = flat.select(*out, *TIEBREAK)
    values = (DERIVED[c]().alias(c) if c in DERIVED else F.col(c) for c in columns if c not in keys)
    return rows.select(*keys, *values, *TIEBREAK)


def overview_snapshots(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed overviews before deduplication. Text fields keep sentinels as they are."""
    columns = list(columns or OVERVIEW.columns)
    fields = [f for f in OVERVIEW.fields if f.column in columns]
    flat = flatten_document(staging, OVERVIEW, [f.source for f in fields])
    values = (typed(F.col(f"`{f.source}`"), f.dtype).alias(f.column) for f in fields)
    return flat.select(*PARTITION_COLUMNS, "symbol", *values, *TIEBREAK)


def deliveries(staging: DataFrame, endpoint: Endpoint, columns: Sequence[str]) -> DataFrame:
    """Every typed row of an endpoint that Bronze holds, before deduplication."""
    return overview_snapshots(staging, columns) if endpoint.is_flat else statement_periods(staging, endpoint, columns)


def latest(rows: DataFrame, endpoint: Endpoint, columns: Sequence[str]) -> DataFrame:
    """The model of an endpoint from its ``deliveries``."""
    return latest_ingest(rows, ["symbol"] if endpoint.is_flat else GRAIN, TIEBREAK).select(*columns)


def statement(
    staging: DataFrame, endpoint: Endpoint, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``(symbol, fiscaldateending, report_type)``, the latest ingested."""
    columns = list(columns or endpoint.columns)
    return latest(deliveries(staging, endpoint, columns), endpoint, columns)


def income_statement(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return statement(staging, INCOME, columns)


def balance_sheet(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return statement(staging, BALANCE, columns)


def cash_flow(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return statement(staging, CASH_FLOW, columns)


def earnings(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return statement(staging, EARNINGS, columns)


def overview(staging: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The latest company snapshot per symbol. Text fields keep sentinels as they are."""
    return statement(staging, OVERVIEW, columns)


MODELS = {
    "overview": overview,
    "income_statement": income_statement,
    "balance_sheet": balance_sheet,
    "cash_flow": cash_flow,
    "earnings": earnings,
}


def register_silver(spark: SparkSession, staging: dict[str, DataFrame]) -> None:
    """Temp views ``int_<model>``: recomputed when read, never stored."""
    for name, frame in staging.items():
        MODELS[name](frame).createOrReplaceTempView(f"int_{ENDPOINTS[name].model}")
