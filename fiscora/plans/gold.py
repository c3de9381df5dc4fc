"""Gold: one wide KPI row per income-statement period."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.catalog import BALANCE, CASH_FLOW, EARNINGS, ENDPOINTS, GOLD_SCHEMA, GRAIN, INCOME, OVERVIEW
from fiscora.functions import exact_ratio, growth
from fiscora.operators.latest import prior_year_value
from fiscora.plans import silver

# Silver columns the mart reads.
INCOME_COLUMNS = (*GRAIN, "reportedcurrency", "ingest_date", "total_revenue", "net_income", "ebitda_calc")
BALANCE_COLUMNS = (
    *GRAIN,
    "total_shareholder_equity",
    "total_current_assets",
    "total_current_liabilities",
    "net_debt",
)
CASH_FLOW_COLUMNS = (*GRAIN, "operating_cashflow", "free_cash_flow")
EARNINGS_COLUMNS = (*GRAIN, "surprise_percentage")
OVERVIEW_COLUMNS = (
    "symbol",
    "sector",
    "industry",
    "country",
    "exchange",
    "ingest_date",
    "pe_ratio",
    "ev_to_ebitda",
)

# Ratio KPIs as (numerator, denominator); amounts are of the row's own period.
RATIOS = {
    "roe": ("net_income", "total_shareholder_equity"),
    "net_margin": ("net_income", "total_revenue"),
    "ebitda_margin": ("ebitda_calc", "total_revenue"),
    "net_debt_to_ebitda": ("net_debt", "ebitda_calc"),
    "current_ratio": ("total_current_assets", "total_current_liabilities"),
    "quality_of_earnings": ("operating_cashflow", "net_income"),
}


@dataclass(frozen=True)
class SilverFrames:
    """Inputs of the mart. Companions must be unique on the grain, the overview on symbol.

    ``by_company``: all of them lie in the same buckets by symbol, so the mart needs no shuffle.
    """

    income: DataFrame
    balance: DataFrame
    cash_flow: DataFrame
    earnings: DataFrame
    overview: DataFrame
    by_company: bool = False

    @classmethod
    def of(cls, models: dict[str, DataFrame], by_company: bool = False) -> SilverFrames:
        """From models by endpoint name."""
        return cls(*(models[e.name] for e in (INCOME, BALANCE, CASH_FLOW, EARNINGS, OVERVIEW)), by_company)

    def by_endpoint(self) -> dict[str, DataFrame]:
        frames = (self.income, self.balance, self.cash_flow, self.earnings, self.overview)
        return dict(zip((e.name for e in (INCOME, BALANCE, CASH_FLOW, EARNINGS, OVERVIEW)), frames, strict=True))


MART_COLUMNS = {
    INCOME.name: INCOME_COLUMNS,
    BALANCE.name: BALANCE_COLUMNS,
    CASH_FLOW.name: CASH_FLOW_COLUMNS,
    EARNINGS.name: EARNINGS_COLUMNS,
    OVERVIEW.name: OVERVIEW_COLUMNS,
}


def latest_for_gold(deliveries: dict[str, DataFrame]) -> SilverFrames:
    """Silver, narrowed to the mart's columns, from typed rows before deduplication."""
    models = {n: silver.latest(deliveries[n], ENDPOINTS[n], c) for n, c in MART_COLUMNS.items()}
    return SilverFrames.of(models)


def silver_for_gold(staging: dict[str, DataFrame]) -> SilverFrames:
    """Silver narrowed to the mart's columns, which also narrows what is parsed."""
    return latest_for_gold({n: silver.deliveries(staging[n], ENDPOINTS[n], c) for n, c in MART_COLUMNS.items()})


def kpi(name: str) -> Column:
    numerator, denominator = RATIOS[name]
    return exact_ratio(F.col(numerator), F.col(denominator))


def join_companions(frames: SilverFrames) -> DataFrame:
    """Income periods with their companions; a period without one keeps NULLs.

    Silver leaves all four statements hashed by the grain, so these joins need no
    further shuffle. Plain equality: a NULL date matches nothing.
    """
    joined = frames.income.select(*INCOME_COLUMNS)
    companions = (
        frames.balance.select(*BALANCE_COLUMNS),
        frames.cash_flow.select(*CASH_FLOW_COLUMNS),
        frames.earnings.select(*EARNINGS_COLUMNS),
    )
    for companion in companions:
        joined = joined.join(companion, list(GRAIN), "left")
    return joined


def join_overview(periods: DataFrame, overview: DataFrame) -> DataFrame:
    """Latest snapshot applied to all history. No broadcast hint: the overview has one
    row per company, so Spark broadcasts it only while its measured size allows."""
    snapshot = overview.select(
        *(F.col(c).alias("overview_snapshot_date" if c == "ingest_date" else c) for c in OVERVIEW_COLUMNS)
    )
    return periods.join(snapshot, "symbol", "left")


def build_gold(frames: SilverFrames) -> DataFrame:
    """The KPI table, rebuilt in full.

    The joins keep exactly one row per income period, so taking the prior-year
    value after them equals taking it before, and saves a shuffle: the rows are
    hashed by symbol once, which serves both the window and the overview join.
    """
    joined = join_companions(frames)
    by_symbol = joined if frames.by_company else joined.repartition("symbol")
    grown = by_symbol.withColumn("prior_revenue", prior_year_value("total_revenue"))
    joined = join_overview(grown, frames.overview)
    computed = {name: kpi(name) for name in RATIOS}
    computed["revenue_yoy_growth"] = growth(F.col("total_revenue"), F.col("prior_revenue"))
    computed["earnings_surprise_pct"] = F.col("surprise_percentage")
    return joined.select(
        *(
            computed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in GOLD_SCHEMA
        )
    )


def gold_from_bronze(staging: dict[str, DataFrame]) -> DataFrame:
    return build_gold(silver_for_gold(staging))


def recent_periods(gold: DataFrame, symbol: str, report_type: str, n: int = 4) -> DataFrame:
    """The newest periods of one company."""
    mine = (F.col("symbol") == symbol) & (F.col("report_type") == report_type)
    return gold.where(mine).orderBy(F.col("fiscaldateending").desc()).limit(n)
