"""Time the headline queries; prints one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from ledgerspark.queries import QUERIES

HEADLINE = [
    "company_summary", "latest_facts", "segment_growth", "segment_performance", "peer_comparison", "time_series", "financial_model", "segment_pivot", "fact_counts", "completeness_score",
    "flattened_facts", "flattened_segments", "newest_filing", "filing_completeness", "sum_to_parent", "page_text", "table_metrics", "json_leaves",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_facts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # compiles the common code
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, wall time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
