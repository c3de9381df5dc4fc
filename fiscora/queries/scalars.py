"""Scalar functions over whole base tables and over payload fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscora.catalog import EARNINGS, INCOME
from fiscora.functions import (
    business_date,
    cents_to_dollars,
    exact_ratio,
    failure_reason,
    first_or_sum,
    growth,
    json_scalar,
    null_if_sentinel,
    redact_api_keys,
    redact_secrets,
    safe_add,
    safe_date,
    safe_integer,
    safe_numeric,
    safe_subtract,
    upper_key,
    weekday,
)
from fiscora.operators.audit import failure_alerts
from fiscora.operators.flatten import DATE_FIELD, flatten_reports, union_reports
from fiscora.plans.silver import statement_periods
from fiscora.queries.expected import SYMBOL, query, ratio
from fiscora.queries.lake import lake
from fiscora.queries.payloads import table
from fiscora.queries.registry import registered

# Largest BIGINT, to provoke overflow.
BIGINT_MAX = 9223372036854775807


@registered(
    "json_scalar",
    """SELECT event_type, count(*) AS n_events, count(v) AS n_values, CAST(sum(v) AS BIGINT) AS sum_k,
         min(v) AS min_k, max(v) AS max_k, CAST(0 AS BIGINT) AS n_missing
       FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS v FROM events)
       GROUP BY event_type""",
)
def json_scalar_query(spark, sf_dir):
    k = safe_integer(json_scalar(F.col("props"), "k"))
    missing = json_scalar(F.col("props"), "absent")
    return (
        table(spark, sf_dir, "events")
        .select("event_type", k.alias("v"), missing.alias("m"))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count("v").alias("n_values"),
            F.sum("v").alias("sum_k"),
            F.min("v").alias("min_k"),
            F.max("v").alias("max_k"),
            F.count("m").alias("n_missing"),
        )
    )


_INCOME_REPORTS = """reports AS (
  SELECT k, ingest_date, report_type, 1 AS one FROM copies
  UNION ALL SELECT DISTINCT k, ingest_date, 'quarterly', 1 FROM copies
    WHERE report_type = 'quarterly' AND k % 25 = 0)"""


@registered(
    "json_array_flatten",
    query(
        f"""SELECT {SYMBOL} AS symbol, ingest_date, report_type, count(*) AS n_reports,
              CAST(count(*) - 1 AS INTEGER) AS last_position
            FROM reports GROUP BY k, ingest_date, report_type""",
        _INCOME_REPORTS,
    ),
)
def json_array_flatten(spark, sf_dir):
    flat = flatten_reports(lake(spark, sf_dir).staging(INCOME), INCOME, [])
    return flat.groupBy("symbol", "ingest_date", "report_type").agg(
        F.count(F.lit(1)).alias("n_reports"), F.max("position").alias("last_position")
    )


@registered(
    "earnings_flatten",
    query(
        f"""SELECT {SYMBOL} AS symbol, ingest_date, report_type, period_end AS fiscaldateending,
              CAST(n * 0.25 AS DECIMAL(38,9)) AS reported_eps,
              CASE WHEN report_type = 'quarterly' THEN CAST(period_end + INTERVAL 30 DAY AS DATE) END AS reported_date,
              CASE WHEN report_type = 'quarterly' THEN 'post-market' END AS report_time
            FROM copies"""
    ),
)
def earnings_flatten(spark, sf_dir):
    columns = ["reported_eps", "reported_date", "report_time"]
    rows = statement_periods(lake(spark, sf_dir).staging(EARNINGS), EARNINGS, columns)
    return rows.select("symbol", "ingest_date", "report_type", "fiscaldateending", *columns)


@registered(
    "union_reports",
    query(f"SELECT {SYMBOL} AS symbol, report_type, period_end, revenue FROM periods"),
)
def union_reports_query(spark, sf_dir):
    periods = lake(spark, sf_dir).periods()
    rows = periods.select(
        F.concat(F.lit("SUP"), F.col("k").cast("string")).alias("symbol"), "report_type", "period_end", "revenue"
    )
    annual, quarterly = (
        rows.where(F.col("report_type") == kind).drop("report_type") for kind in ("annual", "quarterly")
    )
    return union_reports(annual, quarterly)


@registered(
    "sentinel_safe_cast",
    query(
        f"""SELECT {SYMBOL} AS symbol, ingest_date, report_type, strftime(period_end, '%Y-%m-%d') AS raw_date,
              period_end AS parsed_date,
              CASE WHEN n % 13 = 0 THEN 'bad-number' WHEN n % 17 = 0 THEN '9223372036854775808'
                WHEN n % 11 = 0 THEN NULL ELSE CAST(revenue + b AS VARCHAR) END AS cleaned,
              CASE WHEN n % 13 <> 0 AND n % 17 <> 0 AND n % 11 <> 0 THEN revenue + b END AS as_integer,
              CASE WHEN n % 13 = 0 THEN NULL WHEN n % 17 = 0 THEN CAST(9223372036854775808 AS DECIMAL(38,9))
                WHEN n % 11 = 0 THEN NULL ELSE CAST(revenue + b AS DECIMAL(38,9)) END AS as_numeric
            FROM copies
            UNION ALL
            SELECT DISTINCT {SYMBOL}, ingest_date, 'quarterly', 'broken-date', CAST(NULL AS DATE), '42',
              CAST(42 AS BIGINT), CAST(42 AS DECIMAL(38,9))
            FROM copies WHERE report_type = 'quarterly' AND k % 25 = 0"""
    ),
)
def sentinel_safe_cast(spark, sf_dir):
    flat = flatten_reports(lake(spark, sf_dir).staging(INCOME), INCOME, ["totalRevenue"])
    revenue, day = F.col("totalRevenue"), F.col(DATE_FIELD)
    return flat.select(
        "symbol",
        "ingest_date",
        "report_type",
        day.alias("raw_date"),
        safe_date(day).alias("parsed_date"),
        null_if_sentinel(revenue).alias("cleaned"),
        safe_integer(revenue).alias("as_integer"),
        safe_numeric(null_if_sentinel(revenue)).alias("as_numeric"),
    )


_ARITHMETIC = f"""amounts AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN CAST({BIGINT_MAX} AS BIGINT)
      WHEN l_linenumber = 6 THEN CAST(-{BIGINT_MAX} AS BIGINT)
      ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS a,
    CASE WHEN CAST(l_quantity AS BIGINT) % 10 = 0 THEN CAST(0 AS BIGINT)
      WHEN CAST(l_quantity AS BIGINT) % 7 = 0 THEN NULL
      ELSE CAST(l_quantity AS BIGINT) - 25 END AS b FROM lineitem)"""


@registered(
    "safe_arithmetic",
    f"""WITH {_ARITHMETIC}
        SELECT l_orderkey, l_linenumber, TRY(a + b) AS added, TRY(a - b) AS subtracted,
          {ratio("a", "b")} AS quotient, {ratio("(CAST(b AS HUGEINT) - a)", "a")} AS change,
          coalesce(b, TRY(a + l_linenumber)) AS fallback
        FROM amounts""",
)
def safe_arithmetic(spark, sf_dir):
    quantity = F.col("l_quantity").cast("bigint")
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(BIGINT_MAX))
        .when(F.col("l_linenumber") == 6, F.lit(-BIGINT_MAX))
        .otherwise(F.round(F.col("l_extendedprice") * 100).cast("bigint"))
        .alias("a"),
        F.when(quantity % 10 == 0, F.lit(0))
        .when(quantity % 7 == 0, F.lit(None))
        .otherwise(quantity - 25)
        .cast("bigint")
        .alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        safe_add(a, b).alias("added"),
        safe_subtract(a, b).alias("subtracted"),
        exact_ratio(a, b).alias("quotient"),
        growth(b, a).alias("change"),
        first_or_sum(b, a, F.col("l_linenumber").cast("bigint")).alias("fallback"),
    )


@registered(
    "cents_to_dollars",
    """SELECT upper(s_name) AS supplier_key, count(*) AS n_lines,
         CAST(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DECIMAL(30,0))
           * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(38,2)) AS dollars
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY upper(s_name)""",
)
def cents_to_dollars_query(spark, sf_dir):
    # summed per key before the names are joined, so the join moves one row per key
    cents = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
        )
    )
    return (
        cents.join(table(spark, sf_dir, "supplier"), "s_suppkey")
        .groupBy(upper_key(F.col("s_name")).alias("supplier_key"))
        .agg(F.sum("n").alias("n_lines"), F.sum("cents").alias("cents"))
        .select("supplier_key", "n_lines", cents_to_dollars(F.col("cents")).alias("dollars"))
    )


@registered(
    "business_date",
    """SELECT run_date, CAST(isodow(run_date) - 1 AS INTEGER) AS day_index, count(*) AS n_events
       FROM (SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS DATE) AS run_date FROM events)
       GROUP BY run_date""",
)
def business_date_query(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(business_date(F.col("ts")).alias("run_date"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select("run_date", weekday(F.col("run_date")).alias("day_index"), "n_events")
    )


# concat(...) is the same in both dialects, up to the name of the text type
_MESSAGE = """concat('GET /query?symbol=S', CAST(user_id AS {text}), '&ApiKey=k', CAST(event_id AS {text}),
    ' token=t', CAST(user_id AS {text}), ' your API key as Z', CAST(event_id AS {text}),
    CASE WHEN event_type = 'error' THEN ' Rate-Limit reached' ELSE '' END, ' password=p ',
    CASE WHEN event_id % 2 = 0 THEN 'hunter22' ELSE '' END,
    CASE WHEN event_id % 7 = 0 THEN repeat(' a long tail', 300) ELSE '' END)"""
_REDACTED = """regexp_replace(replace(msg, 'hunter22', '***REDACTED***'),
    '(?i)((?:api[_-]?key|token|password)=)[^&\\s]+', '\\1***REDACTED***', 'g')"""
_REASON = "CASE WHEN contains(replace(lower(msg), '-', ' '), 'rate limit') THEN 'rate_limit' ELSE 'task_failure' END"


def _messages(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("msg", F.expr(_MESSAGE.format(text="STRING")))


@registered(
    "redact_messages",
    f"""WITH m AS (SELECT event_id, {_MESSAGE.format(text="VARCHAR")} AS msg FROM events)
        SELECT event_id,
          regexp_replace(regexp_replace(replace(msg, 'hunter22', '***REDACTED_API_KEY***'),
            '(?i)(apikey=)[^&\\s]+', '\\1***REDACTED_API_KEY***', 'g'),
            '(?i)(API key as )([A-Z0-9_-]+)', '\\1***REDACTED_API_KEY***', 'g') AS source_message,
          {_REDACTED} AS job_message, {_REASON} AS reason
        FROM m""",
)
def redact_messages(spark, sf_dir):
    msg = F.col("msg")
    return _messages(spark, sf_dir).select(
        "event_id",
        redact_api_keys(msg, ["hunter22"]).alias("source_message"),
        redact_secrets(msg, ["hunter22"]).alias("job_message"),
        failure_reason(msg).alias("reason"),
    )


@registered(
    "failure_alerts",
    f"""WITH m AS (SELECT *, {_MESSAGE.format(text="VARCHAR")} AS msg FROM events WHERE event_type = 'error')
        SELECT 'job_failure' AS event, concat('job', CAST(user_id % 3 AS VARCHAR)) AS job,
          CAST(event_id AS VARCHAR) AS task, concat('run', CAST(user_id AS VARCHAR)) AS run_id,
          strftime(ts, '%Y-%m-%d') AS logical_date, {_REASON} AS reason, {_REDACTED} AS error
        FROM m""",
)
def failure_alerts_query(spark, sf_dir):
    failed = (
        _messages(spark, sf_dir)
        .where(F.col("event_type") == "error")
        .select(
            F.concat(F.lit("job"), F.col("user_id") % 3).alias("job"),
            F.col("event_id").cast("string").alias("task"),
            F.concat(F.lit("run"), F.col("user_id")).alias("run_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("logical_date"),
            F.col("msg").alias("message"),
        )
    )
    return failure_alerts(failed, ["hunter22"])
