"""Watermark state ``(endpoint, symbol, fiscal_date)``: a snapshot and the increments since.

A batch writes the marks it added or raised, and nothing of the rest, to ``increment=N``. Every
``COMPACT_AFTER`` batches the whole state goes to ``snapshot=N`` as well; snapshots and increments
that the last two snapshots make needless are removed. A folder counts once its ``_SUCCESS``
marker exists, and is never one that the state was read from, so a lost executor
can recompute it.
"""

from __future__ import annotations

import logging
import re

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fiscora.operators import watermark
from fiscora.sources.paths import child_names, delete, exists

STATE_SCHEMA = T.StructType(
    [
        T.StructField("endpoint", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("fiscal_date", T.StringType()),
    ]
)
COMPACT_AFTER = 16
KEPT_SNAPSHOTS = 2
SNAPSHOT, INCREMENT = "snapshot", "increment"

log = logging.getLogger(__name__)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def _path(root: str, kind: str, number: int) -> str:
    return f"{root.rstrip('/')}/{kind}={number}"


def _listed(spark: SparkSession, root: str) -> dict[str, list[int]]:
    """Folder numbers by kind, newest first, from one listing; at most a few dozen."""
    names = child_names(spark, root)
    return {
        kind: sorted((int(m.group(1)) for n in names if (m := re.fullmatch(rf"{kind}=(\d+)", n))), reverse=True)
        for kind in (SNAPSHOT, INCREMENT)
    }


def _complete(spark: SparkSession, root: str, kind: str, number: int) -> bool:
    return exists(spark, f"{_path(root, kind, number)}/_SUCCESS")


def _newest_snapshot(spark: SparkSession, root: str, numbers: list[int], before: int | None) -> int | None:
    known = (n for n in numbers if (before is None or n < before) and _complete(spark, root, SNAPSHOT, n))
    return next(known, None)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored part, or None if its files cannot be read: the companies in it then count as new."""
    try:
        spark.read.parquet(path).schema  # reads a footer
        return spark.read.schema(STATE_SCHEMA).parquet(path)
    except (PySparkException, Py4JError) as error:
        log.warning("state under %s is unreadable and counts as empty: %s", path, type(error).__name__)
        return None


def next_number(spark: SparkSession, root: str) -> int:
    """Number after the last batch that finished."""
    done = (n for n in _listed(spark, root)[INCREMENT] if _complete(spark, root, INCREMENT, n))
    return next(done, -1) + 1


def is_fed(spark: SparkSession, root: str) -> bool:
    return next_number(spark, root) > 0


def read_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """State after the last finished batch (numbered below ``before`` if given); empty when there is none."""
    listed = _listed(spark, root)
    base = _newest_snapshot(spark, root, listed[SNAPSHOT], before)
    since = [n for n in listed[INCREMENT] if (base is None or n > base) and (before is None or n < before)]
    paths = [_path(root, INCREMENT, n) for n in since if _complete(spark, root, INCREMENT, n)]
    paths += [] if base is None else [_path(root, SNAPSHOT, base)]
    parts = [part for p in paths if (part := _read(spark, p)) is not None]
    return watermark.merge(*parts) if parts else empty_state(spark)


def write_increment(marks: DataFrame, root: str, number: int) -> None:
    """Record the marks that batch ``number`` added or raised, possibly none. Writing a number
    again replaces it. The increment is what makes the batch count as finished."""
    spark = marks.sparkSession
    listed = _listed(spark, root)
    base = _newest_snapshot(spark, root, listed[SNAPSHOT], number)
    since = [n for n in listed[INCREMENT] if n < number and (base is None or n > base)]
    rows = marks.select(*STATE_SCHEMA.names)
    if len(since) >= COMPACT_AFTER:
        # the snapshot holds the batches below its number, so a replay of this one still finds its past
        read_state(spark, root, before=number).write.mode("overwrite").parquet(_path(root, SNAPSHOT, number - 1))
        _remove_needless(spark, root, number)
    rows.write.mode("overwrite").parquet(_path(root, INCREMENT, number))


def _remove_needless(spark: SparkSession, root: str, number: int) -> None:
    listed = _listed(spark, root)
    kept = [n for n in listed[SNAPSHOT] if n < number and _complete(spark, root, SNAPSHOT, n)][:KEPT_SNAPSHOTS]
    if len(kept) < KEPT_SNAPSHOTS:
        return
    for kind in (SNAPSHOT, INCREMENT):
        for n in listed[kind]:
            if n < kept[-1] or (kind == INCREMENT and n == kept[-1]):
                delete(spark, _path(root, kind, n))
