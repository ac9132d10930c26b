"""Headline queries, timed; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (names,
comma-separated; default below).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lakesearch.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "validate_split_counts",
    "validate_valid",
    "clean_html",
    "silver_build",
    "silver_dedup_report",
    "sync_new_rows",
    "embed_hashed",
    "vector_points",
    "vector_upsert",
    "bm25_idf",
    "bm25_scores",
    "bm25_topk",
    "dense_topk",
    "dense_groundedness",
    "rrf_fuse",
    "hybrid_search",
    "telemetry_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("validate_split_counts", "vector_points"):  # start the JIT and the Python workers
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
