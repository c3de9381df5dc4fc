"""Field catalogue: one description per endpoint drives the payload contract,
the JSON read schema, the Silver projection and the schema check.

Column names follow from the source names by ``column_name``; only the handful
of irregular ones are listed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.LongType()
RATIO = T.DecimalType(38, 9)

ANNUAL = "annual"
QUARTERLY = "quarterly"
REPORT_TYPES = (ANNUAL, QUARTERLY)
GRAIN = ("symbol", "fiscaldateending", "report_type")

# Texts the source sends in numeric fields that hold no number.
SENTINELS = ("None", "-", "N/A", "")

# Source fields of each endpoint, in output-column order.
INCOME_FIELDS = """
    grossProfit totalRevenue costOfRevenue operatingIncome sellingGeneralAndAdministrative
    researchAndDevelopment operatingExpenses netInterestIncome interestIncome interestExpense
    depreciationAndAmortization incomeBeforeTax incomeTaxExpense
    netIncomeFromContinuingOperations ebit ebitda netIncome
""".split()
INCOME_LATE_FIELDS = """
    costofGoodsAndServicesSold investmentIncomeNet nonInterestIncome otherNonOperatingIncome
    depreciation interestAndDebtExpense comprehensiveIncomeNetOfTax
""".split()
BALANCE_FIELDS = """
    totalAssets totalCurrentAssets cashAndCashEquivalentsAtCarryingValue
    cashAndShortTermInvestments inventory currentNetReceivables totalNonCurrentAssets
    propertyPlantEquipment intangibleAssets goodwill longTermInvestments shortTermInvestments
    totalLiabilities totalCurrentLiabilities currentAccountsPayable shortTermDebt
    totalNonCurrentLiabilities capitalLeaseObligations longTermDebt currentLongTermDebt
    shortLongTermDebtTotal otherCurrentLiabilities totalShareholderEquity retainedEarnings
    commonStock commonStockSharesOutstanding accumulatedDepreciationAmortizationPPE
    intangibleAssetsExcludingGoodwill investments otherCurrentAssets otherNonCurrentAssets
    deferredRevenue currentDebt longTermDebtNoncurrent otherNonCurrentLiabilities treasuryStock
""".split()
CASH_FLOW_FIELDS = """
    operatingCashflow capitalExpenditures depreciationDepletionAndAmortization dividendPayout
    stockBasedCompensation cashflowFromInvestment cashflowFromFinancing netIncome
    paymentsForOperatingActivities proceedsFromOperatingActivities changeInOperatingLiabilities
    changeInOperatingAssets changeInReceivables changeInInventory profitLoss
    proceedsFromRepaymentsOfShortTermDebt paymentsForRepurchaseOfCommonStock
    paymentsForRepurchaseOfEquity paymentsForRepurchaseOfPreferredStock dividendPayoutCommonStock
    dividendPayoutPreferredStock proceedsFromIssuanceOfCommonStock
    proceedsFromIssuanceOfLongTermDebtAndCapitalSecuritiesNet proceedsFromIssuanceOfPreferredStock
    proceedsFromRepurchaseOfEquity proceedsFromSaleOfTreasuryStock
    changeInCashAndCashEquivalents changeInExchangeRate
""".split()
EARNINGS_ANNUAL_FIELDS = ["reportedEPS"]
EARNINGS_QUARTERLY_FIELDS = ["reportedEPS", "estimatedEPS", "surprise", "surprisePercentage"]
OVERVIEW_TEXT_FIELDS = """
    AssetType Name Exchange Currency Country Sector Industry FiscalYearEnd LatestQuarter
    Description CIK Address OfficialSite DividendDate ExDividendDate
""".split()
OVERVIEW_INTEGER_FIELDS = """
    MarketCapitalization EBITDA RevenueTTM GrossProfitTTM SharesOutstanding SharesFloat
""".split()
OVERVIEW_FIELDS = """
    AssetType Name Exchange Currency Country Sector Industry FiscalYearEnd LatestQuarter
    MarketCapitalization PERatio PEGRatio BookValue DividendPerShare DividendYield EPS
    RevenuePerShareTTM ProfitMargin ReturnOnEquityTTM EVToRevenue EVToEBITDA Beta TrailingPE
    ForwardPE PriceToSalesRatioTTM PriceToBookRatio Description CIK Address OfficialSite
    DividendDate ExDividendDate EBITDA RevenueTTM GrossProfitTTM SharesOutstanding SharesFloat
    OperatingMarginTTM ReturnOnAssetsTTM DilutedEPSTTM QuarterlyEarningsGrowthYOY
    QuarterlyRevenueGrowthYOY AnalystTargetPrice AnalystRatingStrongBuy AnalystRatingBuy
    AnalystRatingHold AnalystRatingSell AnalystRatingStrongSell PercentInsiders
    PercentInstitutions 52WeekHigh 52WeekLow 50DayMovingAverage 200DayMovingAverage
""".split()

# Source fields whose column name is not their snake-case form.
IRREGULAR_COLUMNS = {
    "fiscalDateEnding": "fiscaldateending",
    "reportedCurrency": "reportedcurrency",
    "cashAndCashEquivalentsAtCarryingValue": "cash_and_cash_equivalents",
    "costofGoodsAndServicesSold": "cost_of_goods_and_services_sold",
    "52WeekHigh": "week_high_52",
    "52WeekLow": "week_low_52",
    "50DayMovingAverage": "moving_average_50",
    "200DayMovingAverage": "moving_average_200",
}

_WORD_BREAK = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def column_name(source: str) -> str:
    """Silver column for a source field: snake case unless listed as irregular."""
    return IRREGULAR_COLUMNS.get(source) or _WORD_BREAK.sub("_", source).lower()


@dataclass(frozen=True)
class Field:
    """One scalar of a payload."""

    source: str
    dtype: T.DataType

    @property
    def column(self) -> str:
        return column_name(self.source)

    @property
    def is_text(self) -> bool:
        return isinstance(self.dtype, T.StringType)


def _fields(names: list[str], dtype: T.DataType) -> tuple[Field, ...]:
    return tuple(Field(name, dtype) for name in names)


@dataclass(frozen=True)
class Endpoint:
    """A payload family.

    ``model`` names its views and folders. ``annual`` and ``quarterly`` name the report arrays (``None`` for a flat
    payload). ``fields`` are the typed scalars of one report, or of the payload
    itself when it is flat; ``quarterly_only`` are the ones an annual report
    does not have by contract.
    """

    name: str
    model: str
    key: str
    fields: tuple[Field, ...]
    columns: tuple[str, ...]
    annual: str | None = None
    quarterly: str | None = None
    currency_required: bool = False
    quarterly_only: frozenset[str] = frozenset()
    probe_order: tuple[str, ...] = ()

    @property
    def is_flat(self) -> bool:
        return self.annual is None

    @property
    def arrays(self) -> tuple[str, ...]:
        return () if self.is_flat else (self.annual, self.quarterly)

    @property
    def envelope(self) -> tuple[str, ...]:
        """Top-level keys the contract knows."""
        if self.is_flat:
            return (self.key, *(f.source for f in self.fields))
        return (self.key, *self.arrays)

    @property
    def schema(self) -> T.StructType:
        """Silver schema, in output order."""
        return T.StructType([T.StructField(c, self.column_type(c)) for c in self.columns])

    def column_type(self, column: str) -> T.DataType:
        if column in _COMMON_TYPES:
            return _COMMON_TYPES[column]
        for field in self.fields:
            if field.column == column:
                return field.dtype
        return MONEY  # derived amounts


_COMMON_TYPES = {
    "symbol": T.StringType(),
    "report_type": T.StringType(),
    "fiscaldateending": T.DateType(),
    "fiscaldateending_raw": T.StringType(),
    "reportedcurrency": T.StringType(),
    "reported_date": T.DateType(),
    "report_time": T.StringType(),
    "ingest_date": T.DateType(),
    "partition_year": T.LongType(),
    "partition_month": T.LongType(),
    "partition_day": T.LongType(),
}
PARTITION_COLUMNS = ("partition_year", "partition_month", "partition_day", "ingest_date")
_STATEMENT_HEAD = (
    *PARTITION_COLUMNS,
    "symbol",
    "report_type",
    "fiscaldateending_raw",
    "fiscaldateending",
)


def _cols(names: list[str]) -> tuple[str, ...]:
    return tuple(column_name(n) for n in names)


_STATEMENT_ARRAYS = {"annual": "annualReports", "quarterly": "quarterlyReports"}

INCOME = Endpoint(
    name="income_statement",
    model="income_statement",
    key="symbol",
    fields=_fields(INCOME_FIELDS + INCOME_LATE_FIELDS, MONEY),
    columns=(
        "symbol",
        "report_type",
        "fiscaldateending",
        "fiscaldateending_raw",
        "reportedcurrency",
        *_cols(INCOME_FIELDS),
        "ebitda_calc",
        "ingest_date",
        "partition_year",
        "partition_month",
        "partition_day",
        *_cols(INCOME_LATE_FIELDS),
    ),
    currency_required=True,
    probe_order=("annualReports", "quarterlyReports"),
    **_STATEMENT_ARRAYS,
)
BALANCE = Endpoint(
    name="balance_sheet",
    model="balance_sheet",
    key="symbol",
    fields=_fields(BALANCE_FIELDS, MONEY),
    columns=(
        *_STATEMENT_HEAD,
        "reportedcurrency",
        *_cols(BALANCE_FIELDS),
        "total_debt",
        "net_debt",
    ),
    currency_required=True,
    probe_order=("annualReports", "quarterlyReports"),
    **_STATEMENT_ARRAYS,
)
CASH_FLOW = Endpoint(
    name="cash_flow",
    model="cash_flow",
    key="symbol",
    fields=_fields(CASH_FLOW_FIELDS, MONEY),
    columns=(*_STATEMENT_HEAD, "reportedcurrency", *_cols(CASH_FLOW_FIELDS), "free_cash_flow"),
    currency_required=True,
    probe_order=("annualReports", "quarterlyReports"),
    **_STATEMENT_ARRAYS,
)
EARNINGS = Endpoint(
    name="earnings",
    model="earning",
    key="symbol",
    fields=_fields(EARNINGS_QUARTERLY_FIELDS, RATIO),
    columns=(
        *_STATEMENT_HEAD,
        "reported_date",
        *_cols(EARNINGS_QUARTERLY_FIELDS),
        "report_time",
    ),
    annual="annualEarnings",
    quarterly="quarterlyEarnings",
    quarterly_only=frozenset(EARNINGS_QUARTERLY_FIELDS) - frozenset(EARNINGS_ANNUAL_FIELDS),
    probe_order=("quarterlyEarnings", "annualEarnings"),
)


def _overview_type(name: str) -> T.DataType:
    if name in OVERVIEW_TEXT_FIELDS:
        return T.StringType()
    return MONEY if name in OVERVIEW_INTEGER_FIELDS else RATIO


OVERVIEW = Endpoint(
    name="overview",
    model="overview",
    key="Symbol",
    fields=tuple(Field(n, _overview_type(n)) for n in OVERVIEW_FIELDS),
    columns=(*PARTITION_COLUMNS, "symbol", *_cols(OVERVIEW_FIELDS)),
    probe_order=("LatestQuarter", "FiscalYearEnd"),
)

ENDPOINTS = {e.name: e for e in (OVERVIEW, INCOME, BALANCE, CASH_FLOW, EARNINGS)}

# Columns of the KPI table, in output order.
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("fiscaldateending", T.DateType()),
        T.StructField("report_type", T.StringType()),
        T.StructField("reportedcurrency", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("sector", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("overview_snapshot_date", T.DateType()),
        T.StructField("total_revenue", MONEY),
        T.StructField("net_income", MONEY),
        T.StructField("ebitda_calc", MONEY),
        T.StructField("total_shareholder_equity", MONEY),
        T.StructField("total_current_assets", MONEY),
        T.StructField("total_current_liabilities", MONEY),
        T.StructField("net_debt", MONEY),
        T.StructField("operating_cashflow", MONEY),
        T.StructField("roe", RATIO),
        T.StructField("net_margin", RATIO),
        T.StructField("ebitda_margin", RATIO),
        T.StructField("net_debt_to_ebitda", RATIO),
        T.StructField("current_ratio", RATIO),
        T.StructField("free_cash_flow", MONEY),
        T.StructField("quality_of_earnings", RATIO),
        T.StructField("revenue_yoy_growth", RATIO),
        T.StructField("earnings_surprise_pct", RATIO),
        T.StructField("pe_ratio", RATIO),
        T.StructField("ev_to_ebitda", RATIO),
    ]
)
