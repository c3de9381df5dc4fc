"""The latest typed rows of every endpoint, stored in buckets by company.

A version is a bucketed table: hashed by symbol, each bucket sorted by the grain. Joins, windows and tests by
company or by grain then find their rows in place, without a shuffle (``session.SQL_CONF`` names the setting
that lets joins use it). A new batch is merged: its rows alone are shuffled into the buckets, the stored ones are
read where they lie, and the outcome is the next version. Choosing the latest row is the same in any order of
merging, so this equals choosing from all batches at once.

A version counts once the list of batches it covers is written, last of all. It is never one that is
being read, so a lost executor or a run that dies costs nothing but the version it was writing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fiscora.catalog import GRAIN, Endpoint
from fiscora.plans import silver
from fiscora.sources import periods
from fiscora.sources.paths import child_names, delete
from fiscora.sources.versions import next_version, remove_old, version_path, versions

BUCKETS = 32  # tasks that a reader has; about 200 MB of rows each on a large lake
KEPT_VERSIONS = 2  # readers may still be busy with the one before the newest


@dataclass(frozen=True)
class Version:
    """A stored version: its rows, the batches in them, and the number of buckets."""

    rows: DataFrame
    batches: frozenset[int]
    buckets: int


def _folder(root: str, endpoint: Endpoint) -> str:
    return f"{root.rstrip('/')}/{endpoint.name}"


def _rows_path(folder: str, version: int) -> str:
    return version_path(f"{folder}/rows", version)


def _table_name(path: str) -> str:
    return f"fiscora_latest_{hashlib.sha1(path.encode()).hexdigest()[:20]}"


def _keys(endpoint: Endpoint) -> list[str]:
    return ["symbol"] if endpoint.is_flat else list(GRAIN)


def _table(spark: SparkSession, path: str, endpoint: Endpoint, buckets: int) -> DataFrame:
    """The bucketed table of a folder. Buckets are known to the catalogue only, so each session declares it once."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (symbol) "
            f"SORTED BY ({', '.join(_keys(endpoint))}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def _covered(spark: SparkSession, folder: str, version: int) -> tuple[frozenset[int], int]:
    # one row per batch: numbers, not documents
    rows = spark.read.schema("batch long, buckets int").parquet(version_path(folder, version)).collect()
    return frozenset(r["batch"] for r in rows), max(r["buckets"] for r in rows)


def read(spark: SparkSession, root: str, endpoint: Endpoint) -> Version | None:
    """The newest complete version, if there is one."""
    folder = _folder(root, endpoint)
    newest = next(versions(spark, folder), None)
    if newest is None:
        return None
    batches, buckets = _covered(spark, folder, newest)
    return Version(_table(spark, _rows_path(folder, newest), endpoint, buckets), batches, buckets)


def _remove(spark: SparkSession, folder: str, version: int) -> None:
    delete(spark, version_path(folder, version))  # first what makes it count
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(_rows_path(folder, version))}")
    delete(spark, _rows_path(folder, version))


def forget(spark: SparkSession, root: str, endpoint: Endpoint, batch: int) -> None:
    """Drop the versions that hold a batch which is about to be replaced."""
    folder = _folder(root, endpoint)
    for version in list(versions(spark, folder)):
        if batch in _covered(spark, folder, version)[0]:
            _remove(spark, folder, version)


def merge(rows: DataFrame, root: str, endpoint: Endpoint, batches: set[int], buckets: int = BUCKETS) -> Version:
    """Merge the typed rows (``silver.deliveries``) of some batches into the stored ones, as a new version."""
    spark, folder, keys = rows.sparkSession, _folder(root, endpoint), _keys(endpoint)
    stored = read(spark, root, endpoint)
    # chosen among themselves first: a company with a third of all rows then sends one row per period
    fresh = silver.latest(rows, endpoint, rows.columns)
    if stored is not None and set(stored.rows.columns) == set(rows.columns):
        buckets, covered = stored.buckets, stored.batches | batches
        # both sides lie in the same buckets, and so does their union: the stored side is not shuffled
        both = stored.rows.select(*rows.columns).unionByName(fresh.repartition(buckets, "symbol"))
        chosen = silver.latest(both, endpoint, rows.columns)
    else:
        covered, chosen = frozenset(batches), fresh.repartition(buckets, "symbol")
    version = next_version(spark, folder)
    path = _rows_path(folder, version)
    delete(spark, path)  # of a run that died
    writer = chosen.write.bucketBy(buckets, "symbol").sortBy(*keys).format("parquet").mode("overwrite")
    writer.option("path", path).saveAsTable(_table_name(path))
    listed = spark.createDataFrame([(int(b), buckets) for b in sorted(covered)], "batch long, buckets int")
    listed.coalesce(1).write.mode("overwrite").parquet(version_path(folder, version))
    _remove_old(spark, folder)
    return Version(_table(spark, path, endpoint, buckets), covered, buckets)


def _remove_old(spark: SparkSession, folder: str) -> None:
    remove_old(spark, folder, KEPT_VERSIONS)
    kept = {f"version={v}" for v in versions(spark, folder)}
    for name in child_names(spark, f"{folder}/rows"):
        if name not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{folder}/rows/{name}')}")
            delete(spark, f"{folder}/rows/{name}")


def refresh(
    spark: SparkSession, bronze: str, typed: str, root: str, endpoint: Endpoint, columns: tuple[str, ...], buckets: int = BUCKETS
) -> tuple[DataFrame, bool]:
    """The latest row of every key in Bronze, and whether the rows lie in buckets.

    Batches that the stored version lacks are typed and merged into it. Documents outside of numbered batches
    cannot be told apart from one run to the next: they are parsed each time, and the rows then lie in no buckets.
    """
    known = periods.known_batches(spark, bronze, endpoint)
    stored = read(spark, root, endpoint)
    wanted = set(periods.schema(spark, endpoint, columns).names)
    if stored is not None and not (stored.batches <= known and set(stored.rows.columns) == wanted):
        delete(spark, _folder(root, endpoint))
        stored = None
    new = known - (stored.batches if stored is not None else frozenset())
    if new:
        stored = merge(periods.of_batches(spark, bronze, typed, endpoint, columns, new), root, endpoint, new, buckets)
    loose = periods.loose(spark, bronze, endpoint, columns)
    if stored is None:
        return silver.latest(loose, endpoint, columns), False
    if loose is None:
        return stored.rows.select(*columns), True
    names = loose.columns
    return silver.latest(stored.rows.select(*names).unionByName(loose), endpoint, columns), False
