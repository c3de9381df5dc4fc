"""Run one batch from landing folders: ``python -m fiscora --landing DIR --lake DIR --run-id ID``.

Landing holds ``<endpoint>/year=/month=/day=`` folders of JSON lines.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fiscora.catalog import ENDPOINTS
from fiscora.functions import ingest_date
from fiscora.plans.ingest import LakePaths
from fiscora.plans.run import run
from fiscora.sources.bronze import endpoint_path, read_bronze
from fiscora.sources.paths import exists


def main() -> None:
    parser = argparse.ArgumentParser(prog="fiscora", description=__doc__)
    parser.add_argument("--landing", required=True)
    parser.add_argument("--lake", required=True)
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--strict", action="store_true", help="fail when an endpoint is incomplete")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("fiscora").getOrCreate()
    landing = {}
    for name in ENDPOINTS:
        path = endpoint_path(options.landing, name)
        if exists(spark, path):
            day = ingest_date(F.col("year"), F.col("month"), F.col("day"))
            landing[name] = read_bronze(spark, path).select("raw_data", day.alias("ingest_date"))
    if not landing:
        parser.error(f"no endpoint folder under {options.landing}")
    result = run(spark, landing, LakePaths.under(options.lake), options.run_id, allow_partial=not options.strict)
    result.summaries.show(truncate=False)


if __name__ == "__main__":
    main()
