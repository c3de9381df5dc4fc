"""Reading Bronze back, partition pruning, and counting the records of documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscora.functions import ingest_date
from fiscora.operators.contract import payload_row_count
from fiscora.queries.expected import DOCUMENTS, query
from fiscora.queries.lake import lake
from fiscora.queries.registry import registered


def _all_documents(spark, sf_dir) -> DataFrame:
    frames = [
        frame.withColumn("endpoint", F.lit(name)) for name, frame in lake(spark, sf_dir).all_staging().items()
    ]
    return reduce(DataFrame.unionByName, frames)


@registered(
    "bronze_scan",
    query(
        """SELECT endpoint, CAST(year(ingest_date) AS BIGINT) AS year, CAST(month(ingest_date) AS BIGINT) AS month,
             CAST(day(ingest_date) AS BIGINT) AS day, ingest_date, count(*) AS n_documents, count(*) AS n_nonempty
           FROM documents GROUP BY ALL""",
        DOCUMENTS,
    ),
)
def bronze_scan(spark, sf_dir):
    rows = _all_documents(spark, sf_dir)
    return (
        rows.groupBy("endpoint", "year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("n_documents"),
            F.count_if(F.length("raw_data") > 2).alias("n_nonempty"),
        )
        .withColumn("ingest_date", ingest_date(F.col("year"), F.col("month"), F.col("day")))
    )


@registered(
    "bronze_partition_filter",
    query(
        """SELECT endpoint, count(*) AS n_documents FROM documents
           WHERE ingest_date = DATE '2026-09-08' GROUP BY endpoint""",
        DOCUMENTS,
    ),
)
def bronze_partition_filter(spark, sf_dir):
    rows = _all_documents(spark, sf_dir).where((F.col("year") == 2026) & (F.col("month") == 9) & (F.col("day") == 8))
    return rows.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n_documents"))


_RECORDS = """records AS (
  SELECT 'balance_sheet' AS endpoint, k, ingest_date, count(*) AS n FROM copies GROUP BY ALL
  UNION ALL SELECT 'earnings', k, ingest_date, count(*) FROM copies GROUP BY ALL
  UNION ALL SELECT 'cash_flow', k, ingest_date, count(*) FROM copies WHERE n % 10 <> 0 GROUP BY ALL
  UNION ALL SELECT 'income_statement', k, ingest_date,
      count(*) + CAST(any_value(k % 25 = 0) AND bool_or(report_type = 'quarterly') AS INTEGER)
    FROM copies GROUP BY ALL
  UNION ALL SELECT endpoint, k, ingest_date, 1 FROM documents WHERE endpoint = 'overview')"""


@registered(
    "payload_row_count",
    query(
        """SELECT endpoint, ingest_date, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_records,
             min(n) AS least, max(n) AS most
           FROM records GROUP BY endpoint, ingest_date""",
        DOCUMENTS,
        _RECORDS,
    ),
)
def payload_row_count_query(spark, sf_dir):
    rows = _all_documents(spark, sf_dir)
    return (
        rows.select(
            "endpoint",
            ingest_date(F.col("year"), F.col("month"), F.col("day")).alias("ingest_date"),
            payload_row_count(F.col("raw_data")).alias("n"),
        )
        .groupBy("endpoint", "ingest_date")
        .agg(
            F.count(F.lit(1)).alias("n_documents"),
            F.sum("n").alias("n_records"),
            F.min("n").alias("least"),
            F.max("n").alias("most"),
        )
    )


