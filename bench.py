"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. Every query is run to
its last row into a sink that discards them: once to warm up and then three times, of which the median
counts. Streams are run once, until their input is used up. Messages are made beforehand and not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from suite import QUERIES
from suite.mappings import prepare

HEADLINE = [
    "violations_per_rule",
    "violations_from_errors",
    "contract_validate",
    "contract_yaml_equiv",
    "contract_alerts",
    "rule_matches_text",
    "rule_not_future_tol",
    *[name for name in QUERIES if name.startswith("domain_")],
    "silver_json",
    "dlq_json",
    "json_decode",
    "decode_failures",
    "envelope_roundtrip",
    "frame_ids",
    "conformance_errors",
    "route_bronze",
    "route_quarantine",
    "route_counts",
    "freshness_of_joined",
    "quality_report",
    "detection_by_rule",
    "detection_labels",
    "uniqueness",
    "uniqueness_text",
    "top_duplicates",
    "inject_profile",
    "provision_tables",
    "retention_drop",
    "stream_contract",
    "stream_domains",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="contractflow-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("contractflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{work}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark, sf_dir, f"file://{work}/messages")
    seconds = {}
    for name in HEADLINE:
        runs = 1 if name.startswith("stream_") else 4  # the first of four is to warm up; a stream's start is part of it
        timed = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timed[1:] or timed), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
