"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs
twice over its whole input and the second run counts; ``lake_build`` is the single
run that derives the Bronze lake from the tables, ``gold_build`` the one that
writes the Gold table.
"""

from __future__ import annotations

import json
import os
import time

from fiscora.queries import registry
from fiscora.queries.lake import lake, stored_gold
from fiscora.session import local_session

HEADLINE = (
    "silver_income_statement",
    "silver_balance_sheet",
    "silver_cash_flow",
    "silver_earnings",
    "silver_overview",
    "prior_year_value",
    "left_join_companions",
    "gold_kpis",
    "gold_write_read",
    "recent_periods",
    "duplicate_grain",
    "quality_report",
    "kpi_reconciliation",
    "contract_routes",
    "watermark_filter",
    "batch_summary",
    "attempt_metrics",
    "safe_arithmetic",
    "key_batches",
    "json_scalar",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1)))
    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()

    times = {
        "lake_build": seconds(lambda: lake(spark, sf_dir)),
        "gold_build": seconds(lambda: stored_gold(spark, sf_dir)),
    }
    for name in HEADLINE:
        job = registry.QUERIES[name]

        def run(job=job) -> None:
            job(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        times[name] = seconds(run)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
