"""Incremental ingest against a per-company high-water mark of fiscal dates.

Dates compare as text. A document without a date always passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscora.functions import upper_key

KEY = ("endpoint", "watermark_key")
DAY = (*KEY, "ingest_date")
DOCUMENT = "document"


def _with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("watermark_key", upper_key(F.col("symbol")))


def _keyed_state(state: DataFrame) -> DataFrame:
    """State by key; an empty stored date counts as none."""
    return (
        _with_key(state)
        .where(F.col("fiscal_date") != "")
        .groupBy(*KEY)
        .agg(F.max("fiscal_date").alias("stored_date"))
    )


def _is_dated() -> Column:
    return F.coalesce(F.col("fiscal_date") != "", F.lit(False))


def with_document_id(payloads: DataFrame) -> DataFrame:
    """Number documents. Store the result before use: the numbers hold for one evaluation only."""
    return payloads.withColumn(DOCUMENT, F.monotonically_increasing_id())


def daily_marks(payloads: DataFrame, state: DataFrame) -> DataFrame:
    """Per company and ingestion day: its best document, and whether that is news.

    The best document has the newest fiscal date, copies settled by content and, if equal, by
    number. It is news when its date lies beyond the stored mark and beyond every earlier day
    of the same batch. Combined before the shuffle: one small row per company and day
    leaves each task, however many documents a company has.
    """
    best = (
        _with_key(payloads)
        .where(_is_dated())
        .groupBy(*DAY)
        .agg(F.max(F.struct("fiscal_date", "payload_hash", DOCUMENT)).alias("best"))
    )
    earlier_days = Window.partitionBy(*KEY).orderBy("ingest_date").rowsBetween(Window.unboundedPreceding, -1)
    bar = F.greatest("stored_date", "earlier_date")
    return (
        best.withColumn("earlier_date", F.max("best.fiscal_date").over(earlier_days))
        .join(_keyed_state(state), list(KEY), "left")
        .select(*DAY, "best", (bar.isNull() | (F.col("best.fiscal_date") > bar)).alias("beyond"))
    )


def mark_new(payloads: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``is_new``: does the document carry a period beyond its company's mark?

    Input has ``endpoint, symbol, fiscal_date, ingest_date, payload_hash, document``, the last
    a stored unique number. Days count in order, so an earlier day raises the mark for later
    ones; a company stores one document per day, also of identical copies. Documents meet the
    winners by number, which spreads any company evenly. Documents without a date,
    error answers among them, have no mark to meet and are not moved at all.

    The input is read three times and shuffled: keep texts out of it.
    """
    winners = daily_marks(payloads, state).where("beyond").select(F.col(f"best.{DOCUMENT}").alias(DOCUMENT), F.lit(True).alias("_won"))
    dated = (
        payloads.where(_is_dated())
        .join(winners, DOCUMENT, "left")
        .select(*payloads.columns, F.coalesce("_won", F.lit(False)).alias("is_new"))
    )
    undated = payloads.where(~_is_dated()).withColumn("is_new", F.lit(True))
    return dated.unionByName(undated)


def filter_new(payloads: DataFrame, state: DataFrame) -> DataFrame:
    return mark_new(payloads, state).where("is_new").drop("is_new")


def merge(*parts: DataFrame) -> DataFrame:
    """One mark per key: the greatest date of all parts."""
    rows = reduce(DataFrame.unionByName, [_with_key(p).select(*KEY, "fiscal_date") for p in parts])
    return (
        rows.groupBy(*KEY)
        .agg(F.max("fiscal_date").alias("fiscal_date"))
        .select("endpoint", F.col("watermark_key").alias("symbol"), "fiscal_date")
    )


def advance(state: DataFrame, accepted: DataFrame) -> DataFrame:
    """State after a batch: per key the greater of the old date and the accepted ones."""
    return merge(state, accepted.where(_is_dated()))


def raised(state: DataFrame, accepted: DataFrame) -> DataFrame:
    """Only the marks that a batch adds or raises."""
    seen = _with_key(merge(accepted.where(_is_dated())))
    known = _keyed_state(state)
    beyond = F.col("stored_date").isNull() | (F.col("fiscal_date") > F.col("stored_date"))
    return seen.join(known, list(KEY), "left").where(beyond).select("endpoint", "symbol", "fiscal_date")
