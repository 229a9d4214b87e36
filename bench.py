"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Every query runs whole, into a sink that discards its rows: once to
warm up, then three times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.queries import QUERIES  # noqa: E402

HEADLINE = (
    "clean_messy",
    "cast_schema",
    "cast_rejects",
    "dim_distinct",
    "dim_extract_profile",
    "key_dense",
    "key_stable",
    "dim_lookup_multi",
    "dim_lookup_hot",
    "dim_snowflake",
    "star_fact",
    "star_denormalize",
    "flagship",
    "candidate_key",
    "profile_table",
    "profile_documents",
    "pk_violations",
    "fk_orphan_counts",
    "varchar_overflow",
    "src_csv_roundtrip",
    "write_star",
    "listings_clean",
    "listings_fact",
    "listings_round_trip",
    "listings_checks",
)
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(1 + REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total of warm median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
