"""Gold table: parquet, one folder per fiscal date, sorted by company inside.

Every rebuild is a new version, so the table in use stays whole while it runs. Beside a version lies
its index: one row per file with the range of companies in it. A look-up of one company's newest periods
opens the files that may hold it, newest date first, and stops when it has enough.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import GOLD_SCHEMA
from fiscora.sources.paths import exists
from fiscora.sources.versions import latest_version, next_version, remove_old, version_path

PARTITION = "fiscaldateending"
CLUSTER = ("symbol", "report_type")
INDEX_SCHEMA = "fiscaldateending date, file string, first_symbol string, last_symbol string, n_rows long"
KEPT_VERSIONS = 3  # readers may still be busy with the ones before the newest


def write_gold(gold: DataFrame, path: str, *, max_records_per_file: int = 20_000_000) -> int:
    """Write a full rebuild and return its version.

    Fiscal years end on few dates, so one date may hold a third of all rows. The
    rebalance hint gathers each date into few files and lets adaptive execution
    split a date that is too large for one task, where a plain repartition by
    date would not. Rows are then sorted so that file statistics prune by company.
    """
    version = next_version(gold.sparkSession, path)
    (
        gold.hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, *CLUSTER)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        # where a date is split over files, their ranges overlap; the filter then tells row groups apart
        .option("parquet.bloom.filter.enabled#symbol", "true")
        .partitionBy(PARTITION)
        .parquet(version_path(path, version))
    )
    write_index(gold.sparkSession, path, version)
    remove_old(gold.sparkSession, path, KEPT_VERSIONS)
    remove_old(gold.sparkSession, _index_root(path), KEPT_VERSIONS)
    return version


def _index_root(path: str) -> str:
    return f"{path.rstrip('/')}/index"


def write_index(spark: SparkSession, path: str, version: int) -> None:
    """Note the range of companies of every file of a version. Reads the symbols only."""
    rows = spark.read.schema(GOLD_SCHEMA).parquet(version_path(path, version))
    name = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1)  # below the version's folder
    files = rows.groupBy(PARTITION, name.alias("file")).agg(
        F.min("symbol").alias("first_symbol"), F.max("symbol").alias("last_symbol"), F.count(F.lit(1)).alias("n_rows")
    )
    files.write.mode("overwrite").parquet(version_path(_index_root(path), version))


def _index_of(spark: SparkSession, path: str, version: int | None) -> DataFrame | None:
    if version is None or not exists(spark, f"{version_path(_index_root(path), version)}/_SUCCESS"):
        return None
    return spark.read.schema(INDEX_SCHEMA).parquet(version_path(_index_root(path), version))


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The index of the newest complete rebuild; None where its writer died before writing it."""
    return _index_of(spark, path, latest_version(spark, path))


def recent_periods(spark: SparkSession, path: str, symbol: str, report_type: str, n: int = 4) -> DataFrame:
    """The newest periods of one company in the stored table, undated ones last.

    The index names the files that may hold the company: about one per date. They are opened for ``n`` dates, then
    twice as many, and so on until ``n`` periods are found; the result reads no others. A version
    without an index, of a writer that died before it, is searched whole.
    """
    version = latest_version(spark, path)
    index = _index_of(spark, path, version)
    mine = (F.col("symbol") == symbol) & (F.col("report_type") == report_type)
    newest = F.col(PARTITION).desc_nulls_last()
    if index is None:
        return read_gold(spark, path).where(mine).orderBy(newest).limit(n)
    folder = version_path(path, version)

    def opened(files: list[str]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], GOLD_SCHEMA)
        rows = spark.read.schema(GOLD_SCHEMA).option("basePath", folder).parquet(*(f"{folder}/{f}" for f in files))
        return rows.select(*GOLD_SCHEMA.names).where(mine)

    may_hold = index.where((F.col("first_symbol") <= symbol) & (F.col("last_symbol") >= symbol))
    # file names of one company: as many as the calendar has dates, a few times that where dates are split
    listed = may_hold.orderBy(newest, "file").select(PARTITION, "file").collect()
    dates = [[r["file"] for r in files] for _, files in groupby(listed, key=lambda r: r[PARTITION])]
    picked: list[str] = []
    found, at, step = 0, 0, n
    while at < len(dates) and found < n:
        some = [file for files in dates[at : at + step] for file in files]
        here = opened(some).count()
        if here:
            picked += some
        found, at, step = found + here, at + step, 2 * step
    return opened(picked).orderBy(newest).limit(n)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete rebuild, in declared column order. A date filter reads only its folders."""
    version = latest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], GOLD_SCHEMA)
    return spark.read.schema(GOLD_SCHEMA).parquet(version_path(path, version)).select(*GOLD_SCHEMA.names)
