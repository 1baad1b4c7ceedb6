"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tidemark.plans import catalogue

HEADLINE = [
    "latest_view", "change_only_log", "price_moves", "span_islands", "full_episodes", "daily_supply", "market_flow_windows", "market_medians", "cuts_in_window", "market_summary", "pair_confidence", "grid_pairs",
    "components", "clique_clusters", "relist_candidate", "nearest_point", "merge_snapshot", "absence_scope_guard", "three_way_merge", "dedupe_copies", "quantiles_linear", "percentile_nearest", "fold_text", "json_paths",
]


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["latest_view"](spark, sf).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rstrip("/").rpartition("sf")[2]}))
    spark.stop()


if __name__ == "__main__":
    main()
