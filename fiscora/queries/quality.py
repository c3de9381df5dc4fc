"""Data tests, gates, profiles and reconciliations over Silver and Gold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, GRAIN, INCOME
from fiscora.operators import quality
from fiscora.plans import gold, silver
from fiscora.queries.expected import sql_type, statement_rows, with_gold, with_silver
from fiscora.queries.lake import lake, stored_gold, stored_latest
from fiscora.queries.registry import registered
from fiscora.sources.gold_table import read_gold

_UNDEDUPLICATED = f"""SELECT * FROM ({statement_rows(INCOME, "copies")})"""


def _income_copies(spark, sf_dir, columns=("total_revenue",)):
    return silver.statement_periods(lake(spark, sf_dir).staging(INCOME), INCOME, list(columns))


@registered(
    "duplicate_grain",
    with_silver(
        f"""SELECT symbol, fiscaldateending, report_type, count(*) AS n_rows FROM ({_UNDEDUPLICATED})
            GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def duplicate_grain(spark, sf_dir):
    return quality.duplicate_groups(_income_copies(spark, sf_dir), GRAIN)


@registered(
    "not_null_failures",
    with_silver(
        f"""SELECT symbol, report_type, fiscaldateending_raw, ingest_date FROM ({_UNDEDUPLICATED})
            WHERE fiscaldateending IS NULL"""
    ),
)
def not_null_failures(spark, sf_dir):
    rows = quality.not_null_failures(_income_copies(spark, sf_dir), "fiscaldateending")
    return rows.select("symbol", "report_type", "fiscaldateending_raw", "ingest_date")


@registered(
    "accepted_values_failures",
    with_silver("SELECT symbol, exchange, country FROM int_overview WHERE exchange NOT IN ('NYSE', 'NASDAQ')"),
)
def accepted_values_failures(spark, sf_dir):
    rows = silver.overview(lake(spark, sf_dir).staging("overview"), ["symbol", "exchange", "country"])
    return quality.accepted_values_failures(rows, "exchange", ["NYSE", "NASDAQ"])


@registered(
    "unique_failures",
    with_silver("SELECT country, count(*) AS n_rows FROM int_overview GROUP BY country HAVING count(*) > 1"),
)
def unique_failures(spark, sf_dir):
    rows = silver.overview(lake(spark, sf_dir).staging("overview"), ["symbol", "country"])
    return quality.unique_failures(rows, "country")


def _period_tests_sql(model: str, relation: str) -> str:
    label = ", ".join(GRAIN)
    parts = [
        f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS failures"
        f" FROM {relation}"
        for c in GRAIN
    ]
    parts.append(
        f"SELECT '{model}', 'accepted_values', 'report_type', "
        f"count(*) FILTER (report_type NOT IN ('annual', 'quarterly')) FROM {relation}"
    )
    parts.append(
        f"SELECT '{model}', 'unique_combination_of_columns', '{label}', count(*) FROM "
        f"(SELECT {label} FROM {relation} GROUP BY ALL HAVING count(*) > 1)"
    )
    return " UNION ALL ".join(parts)


def _tests_sql(with_gold_model: bool) -> str:
    parts = []
    for name, endpoint in ENDPOINTS.items():
        if endpoint.is_flat:
            parts.append(
                f"SELECT '{name}' AS model, 'not_null' AS test, 'symbol' AS \"column\", "
                f"count(*) FILTER (symbol IS NULL) AS failures FROM int_{name}"
            )
            parts.append(
                f"SELECT '{name}', 'unique', 'symbol', count(*) FROM "
                f"(SELECT symbol FROM int_{name} WHERE symbol IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
            )
        else:
            parts.append(_period_tests_sql(name, f"int_{name}"))
    if with_gold_model:
        parts.append(_period_tests_sql("fundamental_kpis", "gold"))
    return " UNION ALL ".join(parts)


def _silver_models(spark, sf_dir) -> dict[str, DataFrame]:
    """Models narrowed to what the tests read."""
    store = lake(spark, sf_dir)
    return {
        name: silver.MODELS[name](store.staging(name), quality.SILVER_TESTS[name].tested_columns)
        for name in ENDPOINTS
    }


@registered("quality_report", with_gold(_tests_sql(with_gold_model=True)))
def quality_report(spark, sf_dir):
    models = _silver_models(spark, sf_dir)
    silver_report = quality.layer_report(models, quality.SILVER_TESTS)
    kpis = {"fundamental_kpis": read_gold(spark, stored_gold(spark, sf_dir))}
    return silver_report.unionByName(quality.layer_report(kpis, quality.GOLD_TESTS))


@registered(
    "quality_report_raw",
    with_silver(_period_tests_sql("income_reports", f"({_UNDEDUPLICATED})")),
)
def quality_report_raw(spark, sf_dir):
    """The same tests before deduplication, where the uniqueness test fails."""
    rows = _income_copies(spark, sf_dir)
    return quality.test_report(rows, "income_reports", quality.SILVER_TESTS[INCOME.name])


@registered(
    "quality_gate",
    with_gold(
        f"""SELECT 'silver' AS layer, count(*) AS tests, CAST(sum(failures) AS BIGINT) AS failures,
              sum(failures) = 0 AS passed FROM ({_tests_sql(False)})
            UNION ALL
            SELECT 'gold', count(*), CAST(sum(failures) AS BIGINT), sum(failures) = 0
            FROM ({_period_tests_sql("fundamental_kpis", "gold")})"""
    ),
)
def quality_gate(spark, sf_dir):
    silver_report = quality.layer_report(_silver_models(spark, sf_dir), quality.SILVER_TESTS)
    kpis = {"fundamental_kpis": read_gold(spark, stored_gold(spark, sf_dir))}
    gold_report = quality.layer_report(kpis, quality.GOLD_TESTS)
    return quality.gate(silver_report, "silver").unionByName(quality.gate(gold_report, "gold"))


_SPARK_TYPES = {"BIGINT": "bigint", "DECIMAL(38,9)": "decimal(38,9)", "VARCHAR": "string", "DATE": "date"}


def _profile_sql() -> str:
    parts = []
    for name, endpoint in ENDPOINTS.items():
        for column in endpoint.columns:
            kind = _SPARK_TYPES[sql_type(endpoint, column)]
            parts.append(
                f"SELECT '{name}' AS model, '{column}' AS \"column\", '{kind}' AS data_type, "
                f"count(*) AS n_rows, count({column}) AS n_values FROM int_{name}"
            )
    return " UNION ALL ".join(parts)


@registered("catalog_check", with_silver(_profile_sql()))
def catalog_check(spark, sf_dir):
    """Every catalogued column with its actual type and how many values it has."""
    profiles = []
    for name, endpoint in ENDPOINTS.items():
        model = silver.MODELS[name](lake(spark, sf_dir).staging(name))
        wrong = quality.schema_mismatches(model, endpoint.schema)
        if wrong:
            raise ValueError(f"{name}: {wrong}")
        profiles.append(quality.column_profile(model, name))
    return reduce(DataFrame.unionByName, profiles)


# KPI that is no ratio of the row's own amounts, and the four that Gold passes on
_GROWTHS = {"revenue_yoy_growth": ("total_revenue", "prior_revenue")}
_PASSED = {
    "free_cash_flow": "free_cash_flow",
    "earnings_surprise_pct": "surprise_percentage",
    "pe_ratio": "pe_ratio",
    "ev_to_ebitda": "ev_to_ebitda",
}
_KPIS = ", ".join(f"'{name}'" for name in (*gold.RATIOS, *_GROWTHS, *_PASSED))


def _inputs(spark, sf_dir) -> DataFrame:
    """The inputs of all KPIs, joined from the stored latest rows again; the prior year by a self-join on its rank.

    Rows of one company lie in one bucket, so neither the joins nor the ranks shuffle them.
    """
    frames = stored_latest(spark, sf_dir)
    joined = gold.join_companions(frames)
    overview = frames.overview.select("symbol", "pe_ratio", "ev_to_ebitda")
    ranked = joined.withColumn(
        "rank", F.row_number().over(Window.partitionBy("symbol", "report_type").orderBy("fiscaldateending"))
    )
    years_on = F.col("rank") + F.when(F.col("report_type") == "annual", 1).otherwise(4)
    prior = ranked.select("symbol", "report_type", years_on.alias("rank"), F.col("total_revenue").alias("prior_revenue"))
    return ranked.join(prior, ["symbol", "report_type", "rank"], "left").join(
        overview, "symbol", "left"
    )


@registered(
    "kpi_reconciliation",
    with_gold(
        "SELECT kpi, CAST(0 AS BIGINT) AS differing, n AS compared FROM "
        f"(SELECT count(*) AS n FROM gold), (SELECT unnest([{_KPIS}]) AS kpi)"
    ),
)
def kpi_reconciliation(spark, sf_dir):
    """KPIs of the stored Gold table against their inputs from the stored latest rows of all periods."""
    kpis = read_gold(spark, stored_gold(spark, sf_dir))
    return quality.reconcile_kpis(kpis, _inputs(spark, sf_dir), gold.RATIOS, _GROWTHS, _PASSED)


@registered(
    "kpi_reconciliation_planted",
    with_gold(
        f"""SELECT kpi, n AS compared, CASE kpi WHEN 'roe' THEN n_roe WHEN 'revenue_yoy_growth' THEN n_growth
              WHEN 'free_cash_flow' THEN n_cash ELSE 0 END AS differing
            FROM (SELECT count(*) AS n, count(*) FILTER (roe IS NOT NULL AND symbol LIKE '%3') AS n_roe,
                count(*) FILTER (revenue_yoy_growth IS NOT NULL AND report_type = 'annual') AS n_growth,
                count(*) FILTER (free_cash_flow IS NULL) AS n_cash FROM gold),
              (SELECT unnest([{_KPIS}]) AS kpi)"""
    ),
)
def kpi_reconciliation_planted(spark, sf_dir):
    """The same over a table with wrong values: a shifted ratio, a lost growth, an invented amount."""
    kpis = read_gold(spark, stored_gold(spark, sf_dir)).withColumns(
        {
            "roe": F.when(F.col("symbol").like("%3"), F.col("roe") + 1).otherwise(F.col("roe")),
            "revenue_yoy_growth": F.when(F.col("report_type") != "annual", F.col("revenue_yoy_growth")),
            "free_cash_flow": F.coalesce("free_cash_flow", F.lit(1)),
        }
    )
    return quality.reconcile_kpis(kpis, _inputs(spark, sf_dir), gold.RATIOS, _GROWTHS, _PASSED)
