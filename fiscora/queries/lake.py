"""The derived lake: Bronze text of all five endpoints, written once per application.

Queries over Silver and Gold read this Bronze, as a consumer of the lake would. Landing documents come from
the same stored periods, without it.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS, OVERVIEW, Endpoint
from fiscora.plans import silver
from fiscora.plans.gold import MART_COLUMNS, SilverFrames, gold_from_bronze
from fiscora.plans.ingest import stage
from fiscora.queries import payloads
from fiscora.session import shared_dir
from fiscora.sources import latest_rows
from fiscora.sources.bronze import endpoint_path, read_bronze, write_bronze, write_texts
from fiscora.sources.gold_table import write_gold

PERIODS_PER_BUCKET = 250_000  # what one task sorts and joins
LEAST_BUCKETS = 8

_periods: dict[tuple[str, str], str] = {}
_built: dict[tuple[str, str], str] = {}
_gold: dict[tuple[str, str], str] = {}
_latest: dict[tuple[str, str], str] = {}
_landing: dict[tuple[str, str, str, bool], str] = {}
_staged: dict[tuple[str, str, str, bool], str] = {}


def scratch(spark: SparkSession, sf_dir: str, *parts: str) -> str:
    """Folder for derived tables of this application and data set."""
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
    app = spark.sparkContext.applicationId
    return "/".join([shared_dir(spark), "fiscora", app, tag, *parts])


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    periods_path: str

    @property
    def bronze_root(self) -> str:
        return f"{self.root}/bronze"

    def periods(self) -> DataFrame:
        return self.spark.read.parquet(self.periods_path)

    def staging(self, endpoint: Endpoint | str) -> DataFrame:
        name = endpoint if isinstance(endpoint, str) else endpoint.name
        return read_bronze(self.spark, endpoint_path(self.bronze_root, name))

    def all_staging(self) -> dict[str, DataFrame]:
        return {name: self.staging(name) for name in ENDPOINTS}


def derive_payloads(spark: SparkSession, sf_dir: str, periods: DataFrame, endpoint: Endpoint) -> DataFrame:
    if endpoint is OVERVIEW:
        return payloads.overview_payloads(payloads.companies(spark, sf_dir))
    return payloads.statement_payloads(periods, endpoint)


def stored_periods(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the periods that all documents are made of, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _periods:
        path = scratch(spark, sf_dir, "periods")
        payloads.periods(spark, sf_dir).write.mode("overwrite").parquet(path)
        _periods[key] = path
    return _periods[key]


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    found = stored_periods(spark, sf_dir)
    if key not in _built:
        root = scratch(spark, sf_dir, "lake")
        built = Lake(spark, root, found)
        periods = built.periods()

        def fill(endpoint: Endpoint) -> None:
            documents = derive_payloads(spark, sf_dir, periods, endpoint)
            write_bronze(documents, endpoint_path(built.bronze_root, endpoint.name), mode="overwrite")

        # independent jobs of unequal size: run side by side they keep the executors busy
        with ThreadPoolExecutor(len(ENDPOINTS)) as pool:
            list(pool.map(fill, ENDPOINTS.values()))
        _built[key] = root
    return Lake(spark, _built[key], found)


def stored_gold(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the Gold table, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _gold:
        path = scratch(spark, sf_dir, "gold")
        write_gold(gold_from_bronze(lake(spark, sf_dir).all_staging()), path)
        _gold[key] = path
    return _gold[key]


def stored_buckets(n_periods: int) -> int:
    """Buckets of the stored rows: their number grows with the rows, so that what a task sorts does not."""
    return max(LEAST_BUCKETS, ceil(n_periods / PERIODS_PER_BUCKET))


def stored_latest(spark: SparkSession, sf_dir: str) -> SilverFrames:
    """The mart's rows as a lake stores them: the second day's documents merged into the first day's. Once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    root = scratch(spark, sf_dir, "latest")
    if key not in _latest:
        store = lake(spark, sf_dir)
        buckets = stored_buckets(store.periods().count())

        def fill(name: str) -> None:
            endpoint = ENDPOINTS[name]
            for batch, day in enumerate(payloads.DAYS):
                rows = store.staging(name).where(F.col("day") == int(day[-2:]))
                latest_rows.merge(silver.deliveries(rows, endpoint, MART_COLUMNS[name]), root, endpoint, {batch}, buckets)

        with ThreadPoolExecutor(len(ENDPOINTS)) as pool:
            list(pool.map(fill, ENDPOINTS))
        _latest[key] = root
    stored = {name: latest_rows.read(spark, root, e).rows.select(*MART_COLUMNS[name]) for name, e in ENDPOINTS.items()}
    return SilverFrames.of(stored, by_company=True)


def landing(spark: SparkSession, sf_dir: str, endpoint: Endpoint, *, faults: bool = False) -> DataFrame:
    """Documents as they arrive: ``k, ingest_date, raw_data``, honouring the contract
    unless faults are planted. Written once per application, like any landing area."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), endpoint.name, faults)
    if key not in _landing:
        if endpoint is OVERVIEW:
            rows = payloads.overview_payloads(payloads.companies(spark, sf_dir))
        else:
            periods = spark.read.parquet(stored_periods(spark, sf_dir))
            rows = payloads.statement_payloads(periods, endpoint, clean=True)
        if faults:
            rows = payloads.plant_contract_faults(rows, endpoint)
        path = scratch(spark, sf_dir, "landing", endpoint.name, "faulty" if faults else "clean")
        write_texts(rows, path)
        _landing[key] = path
    return spark.read.parquet(_landing[key])


def staged(spark: SparkSession, sf_dir: str, endpoint: Endpoint, *, faults: bool = False) -> DataFrame:
    """Landing documents with their contract verdicts, as an ingest stores them. Once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), endpoint.name, faults)
    if key not in _staged:
        path = scratch(spark, sf_dir, "staged", endpoint.name, "faulty" if faults else "clean")
        stage(landing(spark, sf_dir, endpoint, faults=faults), endpoint, path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])


def day_only(rows: DataFrame, index: int) -> DataFrame:
    return rows.where(F.col("ingest_date") == F.lit(payloads.DAYS[index]).cast("date"))
