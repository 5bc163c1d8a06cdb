"""Times the headline queries and prints one JSON line.

Each query is run twice in one session; the second, warm run counts. Both are reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.queries import (  # noqa: E402
    DEAL,
    KEY,
    ORDERS_SCHEMA,
    layout_json,
    stats_source,
    table,
)
from segloom.functions.hashing import java_hash  # noqa: E402
from segloom.functions.keys import partition_key  # noqa: E402
from segloom.operators.assign import assign_segments, with_partition_id  # noqa: E402
from segloom.operators.manifest import segment_column_stats, segment_manifest  # noqa: E402
from segloom.operators.prune import prune_segments, scan_segments  # noqa: E402
from segloom.operators.sink import write_segments  # noqa: E402
from segloom.plans.job import run_segment_job  # noqa: E402
from segloom.session import fresh_path  # noqa: E402
from segloom.sources.schema import PartitionSpec, load_layout, load_schema  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

LINES = PartitionSpec("l_orderkey", "murmur", 4, 12)
LINE_ORDER = ["l_orderkey", "l_linenumber"]


def pids(spark, column, function, partitions=32):
    rows = with_partition_id(table(spark, SF_DIR, "lineitem"), column, function, partitions)
    return rows.groupBy("pid").count()


def hash_sum(spark):
    """The string hash of 600,000 keys made from numbers, by the general text form."""
    key = partition_key(F.col("l_orderkey"))
    return table(spark, SF_DIR, "lineitem").agg(F.sum(java_hash(key)).alias("h"))


def fold_write(spark):
    spec = PartitionSpec("l_orderkey", "hashcode", 32, 8)
    rows = assign_segments(table(spark, SF_DIR, "lineitem"), spec)
    return segment_manifest(spark, write_segments(rows, fresh_path(spark, "bench"), spec), "t", KEY, 8)


def deal(spark, rows_per_cell=1_000_000):
    rows = assign_segments(table(spark, SF_DIR, "lineitem"), LINES, LINE_ORDER, rows_per_cell)
    return rows.groupBy("segment_id").count()


def deal_write(spark, gather):
    rows = assign_segments(table(spark, SF_DIR, "lineitem"), LINES, LINE_ORDER)
    return segment_manifest(spark, write_segments(rows, fresh_path(spark, "bench"), LINES, gather), "t", KEY, 12)


def prune(spark):
    path = write_segments(assign_segments(table(spark, SF_DIR, "orders"), DEAL, ["o_orderkey"]), fresh_path(spark, "bench"), DEAL)
    return prune_segments(scan_segments(spark, path), DEAL, [77, 1234, 9999])


def job(spark):
    table(spark, SF_DIR, "orders").createOrReplaceTempView("orders")
    layout = load_layout(layout_json("orders_OFFLINE", "o_custkey", "Murmur", 4))
    run = run_segment_job(
        spark,
        "SELECT *, unix_millis(cast(o_orderdate AS timestamp)) AS order_ms FROM orders",
        load_schema(ORDERS_SCHEMA),
        layout,
        KEY,
        fresh_path(spark, "bench"),
        segment_count=12,
    )
    return run.plan


QUERIES = {
    "hash_text": hash_sum,
    "pid_hashcode": lambda s: pids(s, "l_orderkey", "hashcode"),
    "pid_murmur": lambda s: pids(s, "l_orderkey", "murmur"),
    "pid_modulo": lambda s: pids(s, "l_orderkey", "modulo"),
    "fold_write_manifest": fold_write,
    "deal_one_window": deal,
    "deal_in_cells": lambda s: deal(s, 25_000),
    "deal_write_gathered": lambda s: deal_write(s, True),
    "deal_write_direct": lambda s: deal_write(s, False),
    "column_stats_exact": lambda s: segment_column_stats(stats_source(s, SF_DIR), exact=True),
    "column_stats_estimated": lambda s: segment_column_stats(stats_source(s, SF_DIR)),
    "write_and_prune": prune,
    "whole_job": job,
}


def main(names: list[str]) -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("segloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for name in names or QUERIES:
        for seconds in (cold, warm):
            start = time.perf_counter()
            QUERIES[name](spark).collect()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
