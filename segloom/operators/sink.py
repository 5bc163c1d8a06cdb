"""Writing routed rows: one directory ``segment_id=<id>`` per segment below the run's folder."""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.operators.assign import PID, SEGMENT, exchange_tasks
from segloom.sources.formats import JSON_WRITE_OPTIONS, check_storage, writable_format
from segloom.sources.schema import PartitionSpec

# Row group size of a segment file, compression codec, local default folder.
ROW_GROUP_BYTES = 16 * 1024 * 1024
PARQUET_CODEC = "snappy"
LOCAL_BASE = "file:///tmp/segloom"

SLOTS_PER_SEGMENT = 4


def segment_name(table: str, segment_key: str, segment: Column) -> Column:
    return F.concat_ws("_", F.lit(table), F.lit(segment_key), segment.cast("string"))


def segment_uri(target: str, segment: Column) -> Column:
    return F.concat(F.lit(f"{target.rstrip('/')}/{SEGMENT}="), segment.cast("string"))


def target_folder(base: str | None, table: str, segment_key: str) -> str:
    """A folder that no earlier run used: ``<base>/<table>/segments_<key>-<8 hex digits>``."""
    root = base.strip().rstrip("/") if base and base.strip() else LOCAL_BASE
    return f"{root}/{table}/segments_{segment_key}-{secrets.token_hex(4)}"


def gather_segments(df: DataFrame, spec: PartitionSpec | None = None) -> DataFrame:
    """Bring the rows of a segment together, so that it is written as few large files.

    A rebalance rather than a repartition: adaptive execution cuts a segment that holds most
    of the data into several tasks of the advisory size and joins small ones. Rows without a
    partition column all belong to one segment and stay where they are.
    """
    if spec is None:
        return df.hint("rebalance", SEGMENT)
    if spec.column is None:
        return df
    # Several hash slots per segment keep most segments apart; empty slots are merged away.
    return df.hint("rebalance", exchange_tasks(df, SLOTS_PER_SEGMENT * spec.segment_count), SEGMENT)


def route(
    df: DataFrame,
    path: str,
    fmt: str,
    spec: PartitionSpec | None = None,
    gather: bool = True,
) -> str:
    """Write each row to its segment's directory; earlier content of ``path`` is replaced.

    ``gather=False`` skips the exchange by segment. That suits rows that were just dealt to a
    few segments per partition: every task then holds enough rows of each of them.
    """
    spark = df.sparkSession
    fmt = writable_format(spark, fmt)
    check_storage(spark, path)
    rows = df.drop(PID)
    writer = (gather_segments(rows, spec) if gather else rows).write.mode("overwrite").partitionBy(SEGMENT)
    # The folder belongs to this run as a whole: with dynamic overwrite, a segment that
    # became empty would keep its old files.
    writer = writer.option("partitionOverwriteMode", "static")
    if fmt == "parquet":
        writer = writer.option("compression", PARQUET_CODEC).option("parquet.block.size", ROW_GROUP_BYTES)
    elif fmt == "json":
        writer = writer.options(**JSON_WRITE_OPTIONS)
    writer.format(fmt).save(path)
    return path


def write_segments(
    df: DataFrame, target: str, spec: PartitionSpec | None = None, gather: bool = True
) -> str:
    """Persist assigned rows as Parquet segments and return the folder."""
    return route(df, target, "parquet", spec, gather)


def clean_target(spark: SparkSession, uri: str) -> None:
    """Empty a folder, or delete one file; a missing path is left alone."""
    check_storage(spark, uri)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    if path.isRoot():
        raise ValueError("refusing to clean the root of a file system")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return
    if fs.getFileStatus(path).isFile():
        fs.delete(path, False)
        return
    for status in fs.listStatus(path):
        fs.delete(status.getPath(), True)
