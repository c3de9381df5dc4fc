"""Silver models, window and join operators, and the Gold mart over the derived lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscora.catalog import BALANCE, CASH_FLOW, EARNINGS, ENDPOINTS, GOLD_SCHEMA, GRAIN, INCOME, OVERVIEW
from fiscora.operators.latest import latest_ingest, prior_year_value
from fiscora.operators.flatten import TIEBREAK
from fiscora.plans import gold, silver
from fiscora.queries.expected import JOINED, PRIOR, SILVER, query, with_gold, with_silver
from fiscora.queries.lake import lake, stored_gold, stored_latest
from fiscora.queries.registry import registered
from fiscora.sources import gold_table
from fiscora.sources.gold_table import read_gold


def _silver_query(endpoint):
    columns = ", ".join(endpoint.columns)

    @registered(f"silver_{endpoint.name}", with_silver(f"SELECT {columns} FROM int_{endpoint.name}"))
    def job(spark, sf_dir):
        return silver.MODELS[endpoint.name](lake(spark, sf_dir).staging(endpoint))

    return job


for _endpoint in ENDPOINTS.values():
    _silver_query(_endpoint)


@registered(
    "latest_per_key",
    with_silver(
        """SELECT symbol, report_type, fiscaldateending, fiscaldateending_raw, ingest_date, total_revenue
           FROM int_income_statement"""
    ),
)
def latest_per_key(spark, sf_dir):
    rows = silver.statement_periods(lake(spark, sf_dir).staging(INCOME), INCOME, ["total_revenue"])
    columns = [*GRAIN, "fiscaldateending_raw", "ingest_date", "total_revenue"]
    return latest_ingest(rows, GRAIN, TIEBREAK).select(*columns)


@registered(
    "latest_snapshot",
    with_silver("SELECT symbol, ingest_date, market_capitalization, pe_ratio FROM int_overview"),
)
def latest_snapshot(spark, sf_dir):
    columns = ["symbol", "ingest_date", "market_capitalization", "pe_ratio"]
    return silver.overview(lake(spark, sf_dir).staging(OVERVIEW), columns)


@registered(
    "silver_views",
    with_silver(
        """SELECT report_type, count(*) AS n_rows, count(total_revenue) AS n_revenue, max(ingest_date) AS newest
           FROM int_income_statement GROUP BY report_type"""
    ),
)
def silver_views(spark, sf_dir):
    silver.register_silver(spark, lake(spark, sf_dir).all_staging())
    return spark.sql(
        """SELECT report_type, count(*) AS n_rows, count(total_revenue) AS n_revenue, max(ingest_date) AS newest
           FROM int_income_statement GROUP BY report_type"""
    )


@registered(
    "derived_amounts",
    with_silver(
        """SELECT symbol, fiscaldateending, report_type, i.ebitda_calc, b.total_debt, b.net_debt, c.free_cash_flow
           FROM int_income_statement i
           JOIN int_balance_sheet b USING (symbol, fiscaldateending, report_type)
           JOIN int_cash_flow c USING (symbol, fiscaldateending, report_type)"""
    ),
)
def derived_amounts(spark, sf_dir):
    store = lake(spark, sf_dir)
    income = silver.income_statement(store.staging(INCOME), [*GRAIN, "ebitda_calc"])
    balance = silver.balance_sheet(store.staging(BALANCE), [*GRAIN, "total_debt", "net_debt"])
    cash = silver.cash_flow(store.staging(CASH_FLOW), [*GRAIN, "free_cash_flow"])
    return income.join(balance, list(GRAIN)).join(cash, list(GRAIN))


@registered(
    "prior_year_value",
    query(
        "SELECT symbol, fiscaldateending, report_type, total_revenue, prior_revenue FROM prior", SILVER, PRIOR
    ),
)
def prior_year_value_query(spark, sf_dir):
    income = silver.income_statement(lake(spark, sf_dir).staging(INCOME), [*GRAIN, "total_revenue"])
    return income.withColumn("prior_revenue", prior_year_value("total_revenue"))


@registered(
    "left_join_companions",
    query(
        """SELECT symbol, fiscaldateending, report_type, total_shareholder_equity, net_debt, free_cash_flow,
             earnings_surprise_pct AS surprise_percentage, sector, overview_snapshot_date FROM joined""",
        SILVER,
        PRIOR,
        JOINED,
    ),
)
def left_join_companions(spark, sf_dir):
    frames = gold.silver_for_gold(lake(spark, sf_dir).all_staging())
    joined = gold.join_overview(gold.join_companions(frames), frames.overview)
    return joined.select(
        *GRAIN,
        "total_shareholder_equity",
        "net_debt",
        "free_cash_flow",
        "surprise_percentage",
        "sector",
        "overview_snapshot_date",
    )


_GOLD_COLUMNS = ", ".join(GOLD_SCHEMA.names)


@registered("gold_kpis", with_gold(f"SELECT {_GOLD_COLUMNS} FROM gold"))
def gold_kpis(spark, sf_dir):
    return gold.gold_from_bronze(lake(spark, sf_dir).all_staging())


@registered("gold_from_stored_rows", with_gold(f"SELECT {_GOLD_COLUMNS} FROM gold"))
def gold_from_stored_rows(spark, sf_dir):
    """The mart from rows merged batch by batch, restatements included: the same as from all of Bronze."""
    return gold.build_gold(stored_latest(spark, sf_dir))


@registered(
    "stored_rows",
    with_silver(
        " UNION ALL ".join(
            f"SELECT '{name}' AS endpoint, count(*) AS n_rows, count(DISTINCT symbol) AS n_companies FROM int_{name}" for name in ENDPOINTS
        )
    ),
)
def stored_rows(spark, sf_dir):
    """What the merged store holds: one row per key, whatever number of batches it came in."""
    counts = [
        rows.agg(F.lit(name).alias("endpoint"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("n_companies"))
        for name, rows in stored_latest(spark, sf_dir).by_endpoint().items()
    ]
    return reduce(DataFrame.unionByName, counts)


@registered(
    "gold_empty_companions",
    with_gold(
        """SELECT symbol, fiscaldateending, report_type, net_margin, ebitda_margin, revenue_yoy_growth,
             CAST(NULL AS DECIMAL(38,9)) AS roe, CAST(NULL AS BIGINT) AS free_cash_flow,
             CAST(NULL AS DECIMAL(38,9)) AS earnings_surprise_pct, CAST(NULL AS VARCHAR) AS sector
           FROM gold"""
    ),
)
def gold_empty_companions(spark, sf_dir):
    income = silver.income_statement(lake(spark, sf_dir).staging(INCOME), gold.INCOME_COLUMNS)
    empty = {
        e.name: spark.createDataFrame([], e.schema) for e in (BALANCE, CASH_FLOW, EARNINGS, OVERVIEW)
    }
    frames = gold.SilverFrames(
        income=income,
        balance=empty[BALANCE.name],
        cash_flow=empty[CASH_FLOW.name],
        earnings=empty[EARNINGS.name],
        overview=empty[OVERVIEW.name],
    )
    return gold.build_gold(frames).select(
        *GRAIN,
        "net_margin",
        "ebitda_margin",
        "revenue_yoy_growth",
        "roe",
        "free_cash_flow",
        "earnings_surprise_pct",
        "sector",
    )


@registered(
    "gold_write_read",
    with_gold(
        f"""SELECT {_GOLD_COLUMNS} FROM gold
            WHERE fiscaldateending >= DATE '1996-01-01' AND fiscaldateending < DATE '1999-01-01'"""
    ),
)
def gold_write_read(spark, sf_dir):
    date = F.col("fiscaldateending")
    return read_gold(spark, stored_gold(spark, sf_dir)).where((date >= F.lit("1996-01-01")) & (date < F.lit("1999-01-01")))


@registered("gold_stored_whole", with_gold(f"SELECT {_GOLD_COLUMNS} FROM gold"))
def gold_stored_whole(spark, sf_dir):
    """All of the stored table, the folder of unreadable dates included."""
    return read_gold(spark, stored_gold(spark, sf_dir))


@registered(
    "recent_periods",
    with_gold(
        """SELECT symbol, fiscaldateending, report_type, net_margin, roe, current_ratio, free_cash_flow,
             revenue_yoy_growth
           FROM gold WHERE symbol = 'SUP1' AND report_type = 'annual'
           ORDER BY fiscaldateending DESC NULLS LAST LIMIT 4"""
    ),
)
def recent_periods(spark, sf_dir):
    """A look-up through the index of the stored table."""
    found = gold_table.recent_periods(spark, stored_gold(spark, sf_dir), "SUP1", "annual", 4)
    return found.select(*GRAIN, "net_margin", "roe", "current_ratio", "free_cash_flow", "revenue_yoy_growth")


_INDEXED = """SELECT count(*) AS n_rows, count(DISTINCT fiscaldateending) AS n_dates, min(symbol) AS first_symbol, max(symbol) AS last_symbol
  FROM gold"""


@registered("gold_index", with_gold(_INDEXED))
def gold_index(spark, sf_dir):
    """What the index says of the stored table as a whole."""
    index = gold_table.read_index(spark, stored_gold(spark, sf_dir))
    return index.agg(
        F.sum("n_rows").alias("n_rows"),
        F.countDistinct("fiscaldateending").alias("n_dates"),
        F.min("first_symbol").alias("first_symbol"),
        F.max("last_symbol").alias("last_symbol"),
    )
