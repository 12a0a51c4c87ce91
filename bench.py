"""Times the registered queries and the on-disk backfill; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3 by default); the
median counts. Results go to Spark's no-op sink, so all rows are computed.

The given tables are single files of one row group, which Spark reads in one task
whatever the number of cores. Before the timing they are therefore copied once, the
same rows in FILES_PER_CORE files per core, as tables of a size worth measuring have.
BENCH_LAYOUT=given times the files as they are. The line printed says which.

The session has Spark's defaults. BENCH_TUNED=1 times the queries a second time with the
settings that README.md suggests, and prints those times beside the others.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from siltstone.catalog.queries import QUERIES
from siltstone.plans.backfill import backfill
from siltstone.sources.derived import TABLES, raw_table
from siltstone.sources.text_files import read_csv_text

HEADLINE = (
    "silver_clickstream",
    "silver_attributes",
    "silver_financials",
    "silver_loan_daily",
    "keep_first",
    "duplicate_keys",
    "gold_features",
    "gold_features_with_loans",
    "loan_summary",
    "gold_labels",
    "bad_rate_by_mob",
    "feature_store_union",
    "profile_clickstream",
    "profile_financials",
    "profile_loans",
    "null_profile",
    "quality_report",
    "age_histogram",
    "invalid_patterns",
)


FILES_PER_CORE = 2
TUNED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def session(cpus):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median(action, runs, warm_up=True):
    if warm_up:
        action()
    return round(statistics.median(timed(action) for _ in range(runs)), 4)


def spread_tables(spark, sf_dir, folder, cpus):
    """The tables that the queries read, in several files each."""
    for table in ("customer", "orders"):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        rows.repartition(FILES_PER_CORE * int(cpus)).write.parquet(f"{folder}/{table}.parquet")
    return folder


def write_csv_sources(spark, sf_dir, folder):
    """The raw tables as CSV files: what the backfill starts from."""
    sources = {}
    for table in TABLES:
        raw = raw_table(spark, sf_dir, table)
        path = f"{folder}/{table}"
        raw.write.mode("overwrite").option("header", True).csv(path)
        sources[table] = read_csv_text(spark, path, raw.columns)
    return sources


def time_queries(spark, tables, names, runs, seconds):
    for name in names:
        if name in QUERIES:
            run = lambda: QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            seconds[name] = median(run, runs)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or [*HEADLINE, "backfill_24_months"]
    spark = session(cpus)
    seconds, tuned = {}, {}
    layout = os.environ.get("BENCH_LAYOUT", "spread")
    # BENCH_FOLDER: a folder that all executors share, on a cluster.
    with tempfile.TemporaryDirectory(prefix="bench-", dir=os.environ.get("BENCH_FOLDER")) as folder:
        tables = sf_dir if layout == "given" else spread_tables(spark, sf_dir, f"{folder}/tables", cpus)
        time_queries(spark, tables, names, runs, seconds)
        if os.environ.get("BENCH_TUNED"):
            for key, value in TUNED.items():
                spark.conf.set(key, value)
            time_queries(spark, tables, names, runs, tuned)
            for key in TUNED:
                spark.conf.unset(key)
        if "backfill_24_months" in names:
            sources = write_csv_sources(spark, tables, f"{folder}/csv")
            run = lambda: backfill(spark, sources, f"{folder}/mart")
            seconds["backfill_24_months"] = median(run, 1)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "layout": layout,
                **({"tuned": tuned} if tuned else {}),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
