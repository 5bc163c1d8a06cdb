"""Reading only the segments that can hold a key.

A short list of keys becomes literals of the scan. A table of keys never reaches the driver: its segments go to the
scan as a dynamic partition filter, and its keys are met by a semi-join.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructType

from segloom.functions.hashing import partition_function_name, partition_id
from segloom.functions.keys import partition_key, quoted
from segloom.operators.assign import PID, SEGMENT, segment_range, with_partition_id
from segloom.session import fresh_path
from segloom.sources.extract import stage
from segloom.sources.scan import scan
from segloom.sources.schema import PartitionSpec

WANTED = "__wanted"
# Segment ids that are broadcast to the scan; a layout with more joins them by a shuffle.
BROADCAST_SEGMENTS = 1_000_000


def scan_segments(
    spark: SparkSession, target: str, segments: list[int] | None = None, schema: StructType | None = None
) -> DataFrame:
    """Rows of a written folder; a list of ids becomes a partition filter of the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(target)
    return df if segments is None else df.where(F.col(SEGMENT).isin(segments))


def _literal(value):
    """Times and dates as their text, which a cast brings to the type of the column."""
    if isinstance(value, datetime):
        return value.isoformat(" ")
    return value.isoformat() if hasattr(value, "isoformat") else value


def typed_values(spark: SparkSession, values: list, kind: DataType) -> list:
    """``values`` as literals of the key column's type, so that their text is that of stored keys.

    A value that the type cannot hold exactly (1.5 for a whole number) fails.
    """
    literals = [F.lit(_literal(v)) for v in values]
    casts = [literal.cast(kind) for literal in literals]
    numbers = [k for k, v in enumerate(values) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)]
    if numbers and isinstance(kind, NumericType):
        exact = spark.range(1).select(*[casts[k].cast("double") == literals[k].cast("double") for k in numbers]).first()
        if not all(exact):
            raise ValueError(f"not a {kind.simpleString()}: {[values[k] for k, ok in zip(numbers, exact) if not ok]}")
    return casts


def candidate_segments(
    spark: SparkSession, spec: PartitionSpec, values: list, kind: DataType | None = None
) -> list[int]:
    """Ids of all segments that may hold one of ``values``, ascending; ``kind`` is the key column's type."""
    if spec.column is None:
        return [0]
    if not values:
        return []
    keys = [F.struct(partition_key(v).alias("k")) for v in typed_values(spark, values, kind or StringType())]
    pid = partition_id(F.col("k"), spec.function, spec.partition_count)
    first, end = segment_range(F.col("pid"), spec)
    ids = spark.range(1).select(F.inline(F.array(*keys))).select(pid.alias("pid")).distinct().select(F.explode(F.sequence(first, end - 1)).alias("s"))
    return sorted({row.s for row in ids.collect()})


def prune_segments(df: DataFrame, spec: PartitionSpec, values: list) -> DataFrame:
    """Rows whose key is one of ``values``, from the segments that can hold them.

    The id list reaches the scan as a partition filter, the key test as a data filter.
    """
    if spec.column is None:
        raise ValueError("the table has no partition column to prune by")
    key = F.col(quoted(spec.column))
    kind = df.select(key).schema[0].dataType
    ids = candidate_segments(df.sparkSession, spec, values, kind)
    known = typed_values(df.sparkSession, [v for v in values if v is not None], kind)
    return df.where(F.col(SEGMENT).isin(ids) & key_filter(key, known, len(known) < len(values)))


def key_filter(key: Column, known: list[Column], or_null: bool) -> Column:
    matches = key.isin(*known) if known else F.lit(False)
    return matches | key.isNull() if or_null else matches


def typed_keys(keys: DataFrame, column: str, kind: DataType) -> DataFrame:
    """The column's values as ``kind`` under the name ``WANTED``; values that it cannot hold match nothing and go."""
    value = F.col(quoted(column))
    typed = value.try_cast(kind)
    source = keys.select(value).schema[0].dataType
    if isinstance(source, NumericType) and isinstance(kind, NumericType):
        fits = typed.try_cast(source).eqNullSafe(value)
    else:
        fits = typed.isNotNull() | value.isNull()
    return keys.where(fits).select(typed.alias(WANTED))


def key_segments(keys: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Distinct ids of the segments that can hold one of the typed ``keys``."""
    if spec.column is None:
        return keys.select(F.lit(0).alias(SEGMENT)).distinct()
    if partition_function_name(spec.function) == "modulo":
        keys = keys.where(F.col(WANTED).isNotNull())  # such keys cannot have been written
    first, end = segment_range(F.col(PID), spec)
    owned = with_partition_id(keys, WANTED, spec.function, spec.partition_count)
    owned = owned.select(PID).distinct().select(F.explode(F.sequence(first, end - 1)).alias(SEGMENT)).distinct()
    # always true, and what makes the ids a filter that the scan waits for
    return owned.where(F.col(SEGMENT).between(0, spec.segment_count - 1))


def read_segments(df: DataFrame, segments: DataFrame, bound: int) -> DataFrame:
    """Rows of a written folder whose segment is one of ``segments`` (at most ``bound`` ids).

    The ids are found at run time and prune the scan's folders before any file is opened.
    """
    ids = segments.select(F.col(SEGMENT).alias(WANTED))
    ids = F.broadcast(ids) if bound <= BROADCAST_SEGMENTS else ids
    return df.join(ids, F.col(SEGMENT) == F.col(WANTED), "left_semi")


def prune_by_keys(df: DataFrame, spec: PartitionSpec, keys: DataFrame, column: str) -> DataFrame:
    """Rows of a written folder whose key is one of ``keys.column``, from the segments that can hold them.

    ``keys`` may have any number of rows, repeated ones and nulls (which match null keys). It is staged once, as
    both the scan's filter and the semi-join read it.
    """
    if spec.column is None:
        raise ValueError("the table has no partition column to prune by")
    key = F.col(quoted(spec.column))
    typed = typed_keys(keys, column, df.select(key).schema[0].dataType)
    spark = df.sparkSession
    typed = scan(spark, stage(typed, fresh_path(spark, "keys"), "parquet"), "parquet", typed.schema)
    near = read_segments(df, key_segments(typed, spec), spec.segment_count)
    return near.join(typed, key.eqNullSafe(F.col(WANTED)), "left_semi")
