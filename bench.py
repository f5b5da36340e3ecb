"""Wall time of the headline queries; prints one JSON line.

Every query runs from the raw tables through cleaning to its full result, into
Spark's no-op sink, so nothing is pruned or collected. Each runs twice and the
better time counts, since the first run mostly measures compilation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from lakemarts.registry.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2
HEADLINE = (
    "silver_customers",
    "silver_transactions",
    "silver_loan_repayments",
    "dedup_by_key",
    "dedup_by_key_unique",
    "dedup_by_key_replay",
    "mart_financial_health",
    "mart_transactions",
    "mart_loans",
    "mart_loans_exact",
    "mart_fraud",
    "left_join_chain",
    "page_overview",
    "page_transactions",
    "audit_unique",
    "audit_fk",
    "audit_not_null",
    "dirt_profile",
    "canonical_case",
    "repayment_schedule",
    "lakehouse_refresh",
)


def main() -> None:
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakemarts-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    timed = {name: min(seconds(name) for _ in range(RUNS)) for name in chosen}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "wall_time_headline_queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
