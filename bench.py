"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (median is reported) and
BENCH_QUERIES (comma separated, optional).
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from newsloom.catalog.queries import QUERIES  # noqa: E402

HEADLINE = (
    "articles",
    "articles_full",
    "normalize_url",
    "dom_nodes",
    "main_content",
    "clean_paragraphs",
    "dedup_articles",
    "run_report",
    "feed_entries",
    "meta_fields",
    "article_body",
    "entry_pages",
    "new_by_hash",
    "csv_roundtrip",
    "ingest_twice",
    "crawl_articles",
    "incremental_ingest",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("newsloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Call-site capture costs a millisecond per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = session(cpus)
    QUERIES["articles"](spark, sf_dir).count()  # JVM and Python workers warm
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
