"""Window operators: the latest row per key, and the prior-year value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscora.catalog import ANNUAL, QUARTERLY

# How many rows back the same period of the prior year lies.
ROWS_PER_YEAR = {QUARTERLY: 4, ANNUAL: 1}


def keep_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``; NULL keys form a group like any other.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well as after it, so every map task sends at most one row per key
    and a key that holds a third of all rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_ingest(rows: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The most recently ingested row per key.

    The date alone orders ingestions: its day and month add nothing, and would have to
    be shuffled. Copies of one day stay tied; ``tiebreak`` columns then decide, the
    same way on every run.
    """
    return keep_latest(rows, keys, [F.col("ingest_date").desc(), *(F.col(c).asc() for c in tiebreak)])


def prior_year_value(value: str | Column, report_type: str = "report_type") -> Column:
    """Value of the same period one year earlier, counted in rows and not in dates.

    Gaps are not filled. Both lags share one window specification, hence one
    shuffle and sort. Periods per company and type are unique, so a window group
    is bounded by the number of fiscal dates.
    """
    history = Window.partitionBy("symbol", report_type).orderBy(F.col("fiscaldateending").asc_nulls_first())
    case = None
    for kind, offset in ROWS_PER_YEAR.items():
        test, lagged = F.col(report_type) == kind, F.lag(value, offset).over(history)
        case = F.when(test, lagged) if case is None else case.when(test, lagged)
    return case
