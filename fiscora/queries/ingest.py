"""Contract, routing, watermark, replay and streaming ingest over derived documents."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, GRAIN, INCOME, Endpoint
from fiscora.operators import contract, quality, watermark
from fiscora.operators.flatten import flatten_reports
from fiscora.plans import silver
from fiscora.plans.gold import gold_from_bronze
from fiscora.plans.ingest import LakePaths, decide, ingest, stage
from fiscora.queries.expected import DOCUMENTS, PAYLOAD_CLASS, SYMBOL, query, reason_of, route_of
from fiscora.queries.lake import day_only, landing, scratch, staged, stored_gold, stored_periods
from fiscora.queries.payloads import DAYS, MISSING_PERIOD
from fiscora.queries.registry import registered
from fiscora.sources.audit_log import read_ticker_events
from fiscora.sources.bronze import begin_batch, endpoint_path, quarantine_path, read_bronze, write_bronze
from fiscora.sources.gold_table import read_gold
from fiscora.sources.state import empty_state, read_state, write_increment
from fiscora.streaming.ingest import start_ingest

T = TypeVar("T")


def _routed(spark, sf_dir) -> DataFrame:
    """Faulty documents of all endpoints with their routes."""
    frames = [contract.route(landing(spark, sf_dir, e, faults=True), e) for e in ENDPOINTS.values()]
    return reduce(DataFrame.unionByName, frames)


@registered(
    "payload_classes",
    query(f"SELECT endpoint, k, ingest_date, {PAYLOAD_CLASS} AS payload_class FROM documents", DOCUMENTS),
)
def payload_classes(spark, sf_dir):
    return _routed(spark, sf_dir).select("endpoint", "k", "ingest_date", "payload_class")


def _routes_sql() -> str:
    parts = [
        f"""SELECT endpoint, k, ingest_date, {route_of(name)} AS route, {reason_of(e)} AS reason,
              CASE WHEN k % 20 IN (1, 11) THEN 'newEnvelopeField' ELSE '' END AS extra_fields
            FROM documents WHERE endpoint = '{name}'"""
        for name, e in ENDPOINTS.items()
    ]
    return query(" UNION ALL ".join(parts), DOCUMENTS)


@registered("contract_routes", _routes_sql())
def contract_routes(spark, sf_dir):
    return _routed(spark, sf_dir).select(
        "endpoint", "k", "ingest_date", "route", "reason", F.array_join("extra_fields", ",").alias("extra_fields")
    )


def _date_sql(first: str) -> str:
    """Newest fiscal date of the first array that is not empty."""
    return f"strftime(coalesce(max(period_end) FILTER (report_type = '{first}'), max(period_end)), '%Y-%m-%d')"


# the date each document stands for, and whether it lies beyond the one of the day before;
# earnings look at quarters first, an overview names its quarter
_PROBES = f"""dates AS (
  SELECT unnest(['income_statement', 'balance_sheet']) AS endpoint, k, ingest_date, fiscal_date
  FROM (SELECT k, ingest_date, {_date_sql("annual")} AS fiscal_date FROM copies GROUP BY k, ingest_date)
  UNION ALL SELECT 'earnings', k, ingest_date, {_date_sql("quarterly")} FROM copies GROUP BY k, ingest_date
  UNION ALL SELECT 'cash_flow', k, ingest_date, {_date_sql("annual")} FROM copies
  WHERE NOT ({MISSING_PERIOD["cash_flow"]}) GROUP BY k, ingest_date
  UNION ALL SELECT endpoint, k, ingest_date, '2026-06-30' FROM documents WHERE endpoint = 'overview'),
probes AS (
  SELECT *, coalesce(fiscal_date > lag(fiscal_date) OVER (PARTITION BY endpoint, k ORDER BY ingest_date), TRUE) AS beyond
  FROM dates)"""
_ROUTES = "routes AS (" + " UNION ALL ".join(
    f"SELECT endpoint, k, ingest_date, {route_of(name)} AS route FROM documents WHERE endpoint = '{name}'"
    for name in ENDPOINTS
) + ")"
# what an ingest of both days makes of the routes: most of the second day restates known periods
_DECIDED = """decided AS (
  SELECT endpoint, k, ingest_date, CASE WHEN route = 'accepted' AND NOT beyond THEN 'no_change' ELSE route END AS route
  FROM routes JOIN probes USING (endpoint, k, ingest_date))"""


def _clean(spark, sf_dir) -> DataFrame:
    """Checked documents of all endpoints, without their text."""
    checked = _side_by_side(spark, sf_dir, lambda e: staged(spark, sf_dir, e))
    return reduce(DataFrame.unionByName, [_numbered(documents, i) for i, documents in enumerate(checked)])


def _numbered(documents: DataFrame, place: int) -> DataFrame:
    """Document numbers that differ between endpoints too."""
    return documents.drop("raw_data").withColumn("document", F.col("document") * len(ENDPOINTS) + place)


def _planted_state(documents: DataFrame) -> DataFrame:
    """Stored marks by ``k % 3``: 0 already holds the document's date, 1 an older one, 2 none."""
    day7 = day_only(documents, 0)
    date = F.when(F.col("k") % 3 == 0, F.col("fiscal_date")).when(F.col("k") % 3 == 1, "1990-12-31")
    return day7.select("endpoint", "symbol", date.alias("fiscal_date")).where(F.col("fiscal_date").isNotNull())


@registered(
    "watermark_filter",
    query(
        f"""SELECT endpoint, {SYMBOL} AS symbol, ingest_date, fiscal_date,
              beyond AND (k % 3 <> 0 OR ingest_date <> DATE '{DAYS[0]}') AS is_new
            FROM probes""",
        DOCUMENTS,
        _PROBES,
    ),
)
def watermark_filter(spark, sf_dir):
    documents = _clean(spark, sf_dir)
    path = scratch(spark, sf_dir, "planted_state")
    write_increment(_planted_state(documents), path, 0)
    marked = watermark.mark_new(documents, read_state(spark, path))
    return marked.select("endpoint", "symbol", "ingest_date", "fiscal_date", "is_new")


@registered(
    "watermark_copies",
    query(
        f"""SELECT endpoint, {SYMBOL} AS symbol, ingest_date, 3 AS n_copies, CAST(beyond AS INTEGER) AS n_new
            FROM probes""",
        DOCUMENTS,
        _PROBES,
    ),
)
def watermark_copies(spark, sf_dir):
    """Every document delivered three times over: one copy of it is stored."""
    copies = _clean(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2))))
    copies = copies.withColumn("document", F.col("document") * 3 + F.col("copy"))
    marked = watermark.mark_new(copies, empty_state(spark))
    return marked.groupBy("endpoint", "symbol", "ingest_date").agg(
        F.count(F.lit(1)).cast("int").alias("n_copies"), F.count_if("is_new").cast("int").alias("n_new")
    )


@registered(
    "watermark_advance",
    query(
        f"SELECT endpoint, {SYMBOL} AS symbol, max(fiscal_date) AS fiscal_date FROM probes GROUP BY endpoint, k",
        DOCUMENTS,
        _PROBES,
    ),
)
def watermark_advance(spark, sf_dir):
    documents = _clean(spark, sf_dir)
    state = _planted_state(documents)
    return watermark.advance(state, watermark.filter_new(documents, state))


def _clean_paths(spark, sf_dir, *name) -> LakePaths:
    # a fresh lake each time: a second call must not find the batches of the first
    return LakePaths.under(scratch(spark, sf_dir, *name, uuid4().hex))


def _side_by_side(spark, sf_dir, work: Callable[[Endpoint], T]) -> list[T]:
    """One call per endpoint, in the order of the endpoints. These share no folder of a lake but its root: run side by
    side they keep the executors busy, and the batches of one still follow each other."""
    stored_periods(spark, sf_dir)  # before the calls, which would each write it
    with ThreadPoolExecutor(len(ENDPOINTS)) as pool:
        return list(pool.map(work, ENDPOINTS.values()))


def _ingest_days(spark, sf_dir, paths: LakePaths) -> None:
    """Both days of all endpoints, faults included, one batch a day."""

    def both(endpoint: Endpoint) -> None:
        documents = landing(spark, sf_dir, endpoint, faults=True)
        for number in range(len(DAYS)):
            ingest(spark, day_only(documents, number), endpoint, paths, f"run-{number}", batch=number)

    _side_by_side(spark, sf_dir, both)


def _stored_documents(spark, paths, endpoint) -> DataFrame:
    stores = {
        "bronze": endpoint_path(paths.bronze, endpoint.name),
        "quarantine": quarantine_path(paths.bronze, endpoint.name),
    }
    frames = [read_bronze(spark, path).withColumn("store", F.lit(store)) for store, path in stores.items()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.withColumn("endpoint", F.lit(endpoint.name))


def _all_stored(spark, paths) -> DataFrame:
    frames = [_stored_documents(spark, paths, e) for e in ENDPOINTS.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _store_counts(stored: DataFrame) -> DataFrame:
    return stored.groupBy("endpoint", "store", "day").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(F.col("raw_data").contains('"extraction_date":"2026-09-0')).alias("n_stamped"),
    )


_STORES = """SELECT endpoint, CASE route WHEN 'accepted' THEN 'bronze' ELSE 'quarantine' END AS store,
      CAST(day(ingest_date) AS BIGINT) AS day, count(*) AS n_documents, count(*) FILTER (route = 'accepted') AS n_stamped
    FROM decided WHERE route IN ('accepted', 'quarantine') GROUP BY ALL"""


@registered("ingest_stores", query(_STORES, DOCUMENTS, _PROBES, _ROUTES, _DECIDED))
def ingest_stores(spark, sf_dir):
    """Two days of faulty documents through a full ingest; what Bronze and quarantine hold.

    The second day restates known periods, so the watermark keeps it out of Bronze.
    """
    paths = _clean_paths(spark, sf_dir, "ingest")
    _ingest_days(spark, sf_dir, paths)
    return _store_counts(_all_stored(spark, paths))


@registered("replaced_batch", query(_STORES, DOCUMENTS, _PROBES, _ROUTES, _DECIDED))
def replaced_batch(spark, sf_dir):
    """A batch that had other days before it died leaves nothing: its number is replaced whole."""
    paths = _clean_paths(spark, sf_dir, "replaced")

    def die(endpoint: Endpoint) -> None:
        later = day_only(landing(spark, sf_dir, endpoint, faults=True), 1)
        ingest(spark, later, endpoint, paths, "died", batch=0)

    _side_by_side(spark, sf_dir, die)
    _ingest_days(spark, sf_dir, paths)
    return _store_counts(_all_stored(spark, paths))


_FIRST_DAY = """SELECT endpoint, CASE route WHEN 'accepted' THEN 'bronze' ELSE 'quarantine' END AS store,
      CAST(day(ingest_date) AS BIGINT) AS day, count(*) AS n_documents, count(*) FILTER (route = 'accepted') AS n_stamped
    FROM decided WHERE route IN ('accepted', 'quarantine') AND day(ingest_date) = 7 GROUP BY ALL"""


@registered("unfinished_batch", query(_FIRST_DAY, DOCUMENTS, _PROBES, _ROUTES, _DECIDED))
def unfinished_batch(spark, sf_dir):
    """While the second batch is being written anew, readers see the first one alone."""
    paths = _clean_paths(spark, sf_dir, "unfinished")
    _ingest_days(spark, sf_dir, paths)
    for name in ENDPOINTS:
        for store in (endpoint_path(paths.bronze, name), quarantine_path(paths.bronze, name)):
            begin_batch(spark, store, 1)
    return _store_counts(_all_stored(spark, paths))


_EVENT_RECORDS = f"""records AS (
  SELECT unnest(['income_statement', 'balance_sheet', 'earnings']) AS endpoint, k, ingest_date, n
  FROM (SELECT k, ingest_date, count(*) AS n FROM copies GROUP BY ALL)
  UNION ALL SELECT 'cash_flow', k, ingest_date, count(*) FROM copies
  WHERE NOT ({MISSING_PERIOD["cash_flow"]}) GROUP BY ALL
  UNION ALL SELECT endpoint, k, ingest_date, 1 FROM documents WHERE endpoint = 'overview')"""


@registered(
    "audit_events",
    query(
        f"""SELECT endpoint, run_id, status, count(*) AS n_events, CAST(sum(n) AS BIGINT) AS n_records,
              count(message) AS n_messages FROM (
              SELECT upper(endpoint) AS endpoint,
                CASE route WHEN 'accepted' THEN 'SUCCESS' WHEN 'quarantine' THEN 'QUARANTINE' ELSE 'ERROR' END AS status,
                CASE WHEN ingest_date = DATE '{DAYS[0]}' THEN 'run-0' ELSE 'run-1' END AS run_id,
                CASE WHEN k % 20 IN (5, 6, 7, 8, 10) THEN 1 WHEN k % 20 = 9 THEN 0 ELSE n END AS n,
                CASE WHEN route <> 'accepted' THEN route END AS message
              FROM decided JOIN records USING (endpoint, k, ingest_date) WHERE route <> 'no_change')
            GROUP BY ALL""",
        DOCUMENTS,
        _PROBES,
        _ROUTES,
        _DECIDED,
        _EVENT_RECORDS,
    ),
)
def audit_events(spark, sf_dir):
    paths = _clean_paths(spark, sf_dir, "audited")
    _ingest_days(spark, sf_dir, paths)
    events = reduce(DataFrame.unionByName, [read_ticker_events(spark, f"{paths.audit}/{name}") for name in ENDPOINTS])
    return events.groupBy("endpoint", "run_id", "status").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum("rows_processed").alias("n_records"),
        F.count("error_message").alias("n_messages"),
    )


def _bronze(spark, paths) -> dict[str, DataFrame]:
    return {name: read_bronze(spark, endpoint_path(paths.bronze, name)) for name in ENDPOINTS}


def _n_documents(stores: dict[str, DataFrame]) -> int:
    return sum(store.count() for store in stores.values())


def _replay(spark, sf_dir, name: str):
    """Gold and the number of Bronze documents after an ingest of everything, and after the same again."""
    paths = _clean_paths(spark, sf_dir, name)
    grain, counts = [], []
    for batch in range(2):
        _side_by_side(
            spark,
            sf_dir,
            lambda endpoint, batch=batch: ingest(spark, landing(spark, sf_dir, endpoint), endpoint, paths, f"run-{batch}", batch=batch),
        )
        # the files of this state are listed before the next batch runs
        stores = _bronze(spark, paths)
        grain.append(gold_from_bronze(stores).select(*GRAIN))
        counts.append(_n_documents(stores))
    return grain, counts


@registered(
    "idempotent_replay",
    query(
        """SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS duplicates_before,
             CAST(0 AS BIGINT) AS duplicates_after, CAST(0 AS BIGINT) AS keys_added, CAST(0 AS BIGINT) AS keys_lost,
             CAST(0 AS BIGINT) AS documents_added
           FROM periods"""
    ),
)
def idempotent_replay(spark, sf_dir):
    """All documents of all endpoints and days twice, as two batches: Bronze and the Gold grain stay as they are."""
    (before, after), counts = _replay(spark, sf_dir, "replay")
    compared = quality.compare_snapshots(before, after, GRAIN)
    return compared.withColumn("documents_added", F.lit(counts[1] - counts[0]).cast("bigint"))


@registered(
    "replay_differences",
    query(
        """SELECT count(*) AS rows_before,
             count(*) FILTER (k % 10 <> 4) + count(*) FILTER (k % 10 = 3) + count(DISTINCT k) FILTER (k % 10 = 7) AS rows_after,
             CAST(0 AS BIGINT) AS duplicates_before, count(*) FILTER (k % 10 = 3) AS duplicates_after,
             count(DISTINCT k) FILTER (k % 10 = 7) AS keys_added, count(*) FILTER (k % 10 = 4) AS keys_lost
           FROM periods"""
    ),
)
def replay_differences(spark, sf_dir):
    """The comparison does find what it looks for: planted copies, new keys and lost keys."""
    gold = read_gold(spark, stored_gold(spark, sf_dir)).where("fiscaldateending is not null").select(*GRAIN)
    number = F.substring("symbol", 4, 20).cast("bigint")
    copies = gold.where(number % 10 == 3)
    added = gold.where(number % 10 == 7).select("symbol").distinct()
    added = added.select("symbol", F.lit("1900-01-01").cast("date").alias("fiscaldateending"), F.lit("annual").alias("report_type"))
    after = gold.where(number % 10 != 4).unionByName(copies).unionByName(added)
    return quality.compare_snapshots(gold, after, GRAIN)


@registered(
    "decided_routes",
    query(
        "SELECT endpoint, ingest_date, route, count(*) AS n_documents FROM decided GROUP BY ALL",
        DOCUMENTS,
        _PROBES,
        _ROUTES,
        _DECIDED,
    ),
)
def decided_routes(spark, sf_dir):
    frames = _side_by_side(spark, sf_dir, lambda e: decide(staged(spark, sf_dir, e, faults=True), empty_state(spark)))
    return (
        reduce(DataFrame.unionByName, frames)
        .groupBy("endpoint", "ingest_date", "route")
        .agg(F.count(F.lit(1)).alias("n_documents"))
    )


@registered(
    "stream_ingest",
    query(
        """SELECT endpoint, CAST(day(ingest_date) AS BIGINT) AS day, count(*) AS n_documents, any_value(n) AS n_marks
           FROM decided JOIN (SELECT endpoint, count(DISTINCT k) AS n FROM decided WHERE route = 'accepted' GROUP BY 1)
             USING (endpoint) WHERE route = 'accepted' GROUP BY ALL""",
        DOCUMENTS,
        _PROBES,
        _ROUTES,
        _DECIDED,
    ),
)
def stream_ingest(spark, sf_dir):
    """Landing files through the streaming job, twice: the second start finds nothing new."""
    # a stream remembers its files: every call starts streams of its own
    root = scratch(spark, sf_dir, "stream", uuid4().hex)
    paths = LakePaths.under(f"{root}/lake")

    def fed(endpoint: Endpoint) -> DataFrame:
        name = endpoint.name
        write_bronze(landing(spark, sf_dir, endpoint, faults=True), f"{root}/landing/{name}", mode="overwrite")
        for _ in range(2):
            start_ingest(spark, f"{root}/landing/{name}", endpoint, paths, f"{root}/checkpoint/{name}").awaitTermination()
        marks = read_state(spark, paths.state_of(endpoint)).agg(F.count(F.lit(1))).scalar()
        stored = read_bronze(spark, endpoint_path(paths.bronze, name)).groupBy("day").agg(F.count(F.lit(1)).alias("n_documents"))
        return stored.select(F.lit(name).alias("endpoint"), "day", "n_documents", marks.alias("n_marks"))

    return reduce(DataFrame.unionByName, _side_by_side(spark, sf_dir, fed))


def _planted(spark, sf_dir, pattern: str, replacement: str, remainder: int) -> DataFrame:
    """Clean income documents; those with ``k % 10 = remainder`` have the pattern replaced once."""
    documents = landing(spark, sf_dir, INCOME)
    changed = F.regexp_replace("raw_data", pattern, replacement)
    return documents.withColumn("raw_data", F.when(F.col("k") % 10 == remainder, changed).otherwise(F.col("raw_data")))


def _as_staging(documents: DataFrame) -> DataFrame:
    day = F.col("ingest_date")
    return documents.select("raw_data", *(f(day).cast("bigint").alias(n) for n, f in (("year", F.year), ("month", F.month), ("day", F.day))))


@registered(
    "foreign_elements",
    query(
        f"""SELECT {SYMBOL} AS symbol, ingest_date, report_type,
              count(*) + CASE WHEN k % 10 = 3 AND report_type = 'annual' THEN 2 ELSE 0 END AS n_reports,
              CAST(CASE WHEN k % 10 = 3 AND report_type = 'annual' THEN 2 ELSE 0 END AS BIGINT) AS n_empty,
              CAST(sum(revenue + b) AS DECIMAL(38,0)) AS revenue
            FROM copies GROUP BY k, ingest_date, report_type"""
    ),
)
def foreign_elements(spark, sf_dir):
    """Report arrays with a number and a text among the reports: these cost a row each, and no report."""
    documents = _planted(spark, sf_dir, r'^(.*?"annualReports":\[)', r'$17,"x",', 3)
    reports = flatten_reports(_as_staging(documents), INCOME, ["totalRevenue"])
    return reports.groupBy("symbol", "ingest_date", "report_type").agg(
        F.count(F.lit(1)).alias("n_reports"),
        F.count_if(F.col("fiscalDateEnding").isNull()).alias("n_empty"),
        F.sum(F.col("totalRevenue").cast("decimal(38,0)")).cast("decimal(38,0)").alias("revenue"),
    )


@registered(
    "exponent_amounts",
    query(
        f"""SELECT {SYMBOL} AS symbol, ingest_date, 'accepted' AS route, count(*) AS n_reports, count(*) AS n_revenues,
              CAST(k % 10 = 7 AS BIGINT) AS n_written_out
            FROM copies GROUP BY k, ingest_date"""
    ),
)
def exponent_amounts(spark, sf_dir):
    """A revenue sent as ``1e3`` is accepted, stored as 1000, and read as that."""
    documents = _planted(spark, sf_dir, r'^(.*?"totalRevenue":)"[^"]*"', "$1 1e3", 7)
    path = scratch(spark, sf_dir, "exponents")
    checked = stage(documents, INCOME, path)
    stored = checked.withColumn("raw_data", contract.plain_integers(F.col("raw_data"), INCOME))
    rows = silver.statement_periods(_as_staging(stored), INCOME, ["total_revenue"])
    routes = checked.select("symbol", "ingest_date", "route")
    return (
        rows.groupBy("symbol", "ingest_date")
        .agg(
            F.count(F.lit(1)).alias("n_reports"),
            F.count("total_revenue").alias("n_revenues"),
            F.count_if(F.col("total_revenue") == 1000).alias("n_written_out"),
        )
        .join(routes, ["symbol", "ingest_date"])
    )
