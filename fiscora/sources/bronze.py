"""Bronze: one JSON document per text line under ``year=/month=/day=``.

A partition holds many documents per file, so the number of files follows the
number of write tasks and not the number of companies. Files are compressed with gzip, which shrinks
these repetitive texts about tenfold and cannot be split, so a file ends after ``DOCUMENTS_PER_FILE``.

Numbered batches lie in folders above the dates. The folder ``_finished`` lists those that are wholly
written; readers skip all others, so nobody sees half a batch, or two halves while one is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import ENDPOINTS
from fiscora.sources.paths import child_names, delete, touch

PARTITIONS = ("year", "month", "day")
BATCH = "batch"
BATCH_FOLDER = re.compile(rf"{BATCH}=(\d+)")
FINISHED = "_finished"
DOCUMENTS_PER_FILE = 10_000  # one read task each
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
DATES_AT_ONCE = 16  # files a task keeps open; with more dates, it sorts the rest of its texts by date
STAGING_SCHEMA = T.StructType(
    [
        T.StructField("raw_data", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("month", T.LongType()),
        T.StructField("day", T.LongType()),
    ]
)


def _folder(endpoint: str) -> str:
    return ENDPOINTS[endpoint].model if endpoint in ENDPOINTS else endpoint


def endpoint_path(root: str, endpoint: str) -> str:
    return f"{root.rstrip('/')}/{_folder(endpoint)}"


def quarantine_path(root: str, endpoint: str) -> str:
    return f"{root.rstrip('/')}/quarantine/{_folder(endpoint)}"


def begin_batch(spark: SparkSession, path: str, batch: int) -> None:
    """Hide a batch from readers, until it is finished (again)."""
    touch(spark, f"{path}/{FINISHED}/_started")  # from now on the list counts
    delete(spark, f"{path}/{FINISHED}/{BATCH}={batch}")


def finish_batch(spark: SparkSession, path: str, batch: int) -> None:
    """Show a batch to readers. Call it once the batch is wholly written."""
    touch(spark, f"{path}/{FINISHED}/{BATCH}={batch}")


def _folders(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Folders of the batches to read, and of documents outside of batches."""
    names = child_names(spark, path)
    shown = [n for n in names if not n.startswith(("_", "."))]
    numbered = [n for n in shown if BATCH_FOLDER.fullmatch(n)]
    others = [n for n in shown if n not in set(numbered)]
    if FINISHED in names:
        finished = set(child_names(spark, f"{path}/{FINISHED}"))
        numbered = [n for n in numbered if n in finished]
    return numbered, others


def finished_batches(spark: SparkSession, path: str) -> frozenset[int]:
    """Numbers of the batches that readers see. Where no batch was ever begun by name, all of them."""
    return frozenset(int(BATCH_FOLDER.fullmatch(n).group(1)) for n in _folders(spark, path)[0])


def _read_folders(spark: SparkSession, path: str, names: list[str]) -> DataFrame | None:
    if not names:
        return None
    lines = spark.read.option("basePath", path).text([f"{path}/{n}" for n in names])
    return staging(lines) if set(PARTITIONS) <= set(lines.columns) else None


def read_batch(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """One batch's staging rows; None if no document was stored. No other folder is listed."""
    return _read_folders(spark, path.rstrip("/"), [f"{BATCH}={batch}"])


def read_loose(spark: SparkSession, path: str) -> DataFrame | None:
    """Staging rows outside of numbered batches; None if there are none."""
    path = path.rstrip("/")
    return _read_folders(spark, path, _folders(spark, path)[1])


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """``raw_data, year, month, day``; a filter on the last three prunes folders.

    Bronze written by ``ingest`` also has ``batch``, which orders deliveries of one
    day. Batches that are not finished are left out. A folder in which no document was ever stored, or
    none yet, gives an empty frame.
    """
    path = path.rstrip("/")
    numbered, others = _folders(spark, path)
    parts = [p for p in (_read_folders(spark, path, numbered), _read_folders(spark, path, others)) if p is not None]
    if not parts:
        return empty_staging(spark)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def staging(bronze: DataFrame) -> DataFrame:
    """The staging columns, nothing parsed, duplicates kept."""
    raw = "raw_data" if "raw_data" in bronze.columns else "value"
    numbers = [c for c in (*PARTITIONS, BATCH) if c in bronze.columns]
    return bronze.select(
        F.col(raw).cast("string").alias("raw_data"), *(F.col(c).cast("bigint").alias(c) for c in numbers)
    )


def empty_staging(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STAGING_SCHEMA)


def register_staging(spark: SparkSession, root: str, endpoints: list[str]) -> None:
    """One temp view ``stg_<model>`` per endpoint."""
    for endpoint in endpoints:
        view = f"stg_{_folder(endpoint)}"
        read_bronze(spark, endpoint_path(root, endpoint)).createOrReplaceTempView(view)


def partition_columns(ingest_date: Column) -> dict[str, Column]:
    """Folder values of an ingestion date, zero-padded as on disk."""
    return {
        "year": F.date_format(ingest_date, "yyyy"),
        "month": F.date_format(ingest_date, "MM"),
        "day": F.date_format(ingest_date, "dd"),
    }


def one_line(raw: Column) -> Column:
    """A document on one line. JSON strings hold no raw line breaks, so only layout changes."""
    return F.translate(raw, "\r\n", "  ")


_writing: Counter[int] = Counter()  # by session
_writing_lock = Lock()


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Let tasks keep a file open per date, instead of sorting whole texts by date (and spilling them) before
    the first is written. Writes of a session may overlap: the last one puts its setting back. A number of the session's own stays.
    """
    session = spark._jsparkSession.hashCode()
    with _writing_lock:
        ours = _writing[session] > 0 or spark.conf.get(OPEN_FILES) == "0"
        if ours:
            spark.conf.set(OPEN_FILES, str(DATES_AT_ONCE))
            _writing[session] += 1
    try:
        yield
    finally:
        with _writing_lock:
            if ours:
                _writing[session] -= 1
                if _writing[session] == 0:
                    spark.conf.unset(OPEN_FILES)
                    del _writing[session]


def write_bronze(
    payloads: DataFrame,
    path: str,
    *,
    mode: str = "append",
    batch: int | None = None,
) -> None:
    """Write ``raw_data`` under the folders of ``ingest_date``.

    Appending the same documents again is harmless: Silver keeps one row per
    period. A numbered batch has a folder of its own above the dates and replaces
    all that this number held before, whatever days that were. Texts go to the files of their
    dates as they come, so a task needs no room for them.
    """
    rows = payloads.select(
        one_line(F.col("raw_data")).alias("value"),
        *(c.alias(n) for n, c in partition_columns(F.col("ingest_date")).items()),
    )
    writer = rows.write.partitionBy(*PARTITIONS).option("partitionOverwriteMode", "static")
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
    with _unsorted(payloads.sparkSession):
        if batch is None:
            writer.mode(mode).text(path)
        else:
            writer.mode("overwrite").text(f"{path.rstrip('/')}/{BATCH}={batch}")


def write_texts(rows: DataFrame, path: str) -> None:
    """Store documents with other columns of theirs as Parquet, for a later step to read: as small as Bronze, in files as bounded."""
    writer = rows.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
    writer.parquet(path)


def write_quarantine(payloads: DataFrame, root: str, endpoint: str, **options) -> None:
    """Original documents with unknown fields, in the same layout under their own prefix.
    Options are those of ``write_bronze``."""
    write_bronze(payloads, quarantine_path(root, endpoint), **options)
