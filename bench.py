"""Times the headline queries and prints one JSON line.

Each query runs from its source tables, shares nothing with the others and is run to its
last row. Every query runs once unmeasured; the measure is the median of BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workloads.queries import registry  # noqa: E402

HEADLINE = (
    "extract_links",
    "slugs",
    "parse_created",
    "page_metadata",
    "page_body",
    "media_hash",
    "thread_listing",
    "canonical_pages",
    "merged_links",
    "post_ids",
    "posts",
    "comments",
    "feed_summary",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillstack-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quillstack-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session()
    queries = registry()
    seconds = {}
    for name in names:
        timed(queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    out = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
