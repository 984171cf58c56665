"""Time the headline queries; prints one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "ingest_statements",
    "raw_transactions",
    "classified_ledger",
    "unknown_descriptions",
    "mapped_labels",
    "mapped_labels_shuffled",
    "entity_match",
    "entity_match_by_join",
    "ledger_with_trips",
    "ledger_with_trips_shuffled",
    "master_ledger",
    "master_ledger_shuffled",
    "loan_tracking",
    "insert_if_absent",
    "upsert_labels",
    "monthly_burn",
    "compare_months",
    "monthly_pivot",
    "tax_summary",
    "platform_analysis",
    "high_spenders",
    "monthly_resample",
    "weekly_resample",
    "running_balance",
]
WARM_RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def timed(spark: SparkSession, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, cold = {}, {}
    for name in HEADLINE:
        cold[name] = round(timed(spark, folder, name), 3)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(WARM_RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total of warm medians, headline queries, noop sink",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
