"""Runs registered queries next to their SQL and compares names, types and rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalog.oracle import ORACLE  # noqa: E402
from catalog.queries import QUERIES, TABLES  # noqa: E402

# DuckDB type names and the Spark names of the same types.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "float",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "FLOAT[]": "array<float>",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, name, sf_dir):
    """Problem text, or None when both sides agree."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in ORACLE:
        return None if rows else "no rows"
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    spark_types = dict(df.dtypes)
    for column, kind in zip(columns, [str(d[1]) for d in result.description]):
        want = SAME_TYPE.get(kind, kind.lower().replace(" ", ""))
        if spark_types[column] != want and not (want == '"null"'):
            return f"type of {column}: {spark_types[column]} against {kind}"
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    actual = Counter(tuple(plain(r[c]) for c in sorted(columns)) for r in rows)
    if expected != actual:
        missing, extra = expected - actual, actual - expected
        return f"{sum(actual.values())} rows against {sum(expected.values())}; missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    return None if rows else "both sides are empty"


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
