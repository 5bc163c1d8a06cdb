"""Membership sketches: Bloom filters of columns by segment, for lookups by columns that are not the partition key.

A sketch is a table of 64-bit words, built by one aggregation that combines before the exchange, and probed by a
join: no filter and no value passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.functions.keys import quoted
from segloom.operators.assign import SEGMENT
from segloom.operators.prune import WANTED, read_segments, scan_segments, typed_keys
from segloom.session import fresh_path
from segloom.sources.extract import stage
from segloom.sources.scan import scan

HASHES = 5
# Bits for each distinct value: under 2 % false positives with five hashes.
BITS_PER_VALUE = 10
# Bits of a segment's filter of one column (1 MiB at most); beyond it there are more false positives.
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 23
MEMBERS = "_members"


def filter_bits(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """A power of two for each column, by the estimated distinct values of the segment with most."""
    seen = df.groupBy(SEGMENT).agg(*[F.approx_count_distinct(quoted(c)).alias(f"n{k}") for k, c in enumerate(columns)])
    row = seen.agg(*[F.max(f"n{k}") for k in range(len(columns))]).first()
    return {c: min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_VALUE * (n or 1) - 1).bit_length())) for c, n in zip(columns, row)}


def _positions(value: Column, bits: Column) -> Column:
    """The places of a value's hash in a filter of ``bits`` bits (a power of two)."""
    low, high = value.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(value, 32).bitwiseOR(F.lit(1))
    return F.array(*[(low + k * high).bitwiseAND(bits - 1) for k in range(HASHES)])


def _word(place: Column) -> tuple[Column, Column]:
    word = F.shiftright(place, 6).cast("int")
    return word, F.expr("shiftleft(1L, cast(place & 63 AS int))")


def member_sketch(df: DataFrame, columns: list[str], bits: dict[str, int] | None = None) -> DataFrame:
    """``segment_id``, ``column_name``, ``bits``, ``word`` and ``mask``: the filters' words that are not 0.

    Nulls are members like any value. Each (segment, column, value) counts once, so a value that fills a third of the
    rows leaves a task once.
    """
    sizes = bits or filter_bits(df, columns)
    values = [
        F.struct(F.lit(c).alias("column_name"), F.lit(sizes[c]).cast("bigint").alias("bits"), F.xxhash64(quoted(c)).alias("hash"))
        for c in columns
    ]
    members = df.select(SEGMENT, F.inline(F.array(*values))).distinct()
    places = members.select(SEGMENT, "column_name", "bits", F.explode(_positions(F.col("hash"), F.col("bits"))).alias("place"))
    word, mask = _word(F.col("place"))
    words = places.select(SEGMENT, "column_name", "bits", word.alias("word"), mask.alias("mask"))
    return words.groupBy(SEGMENT, "column_name", "bits", "word").agg(F.bit_or("mask").alias("mask"))


def write_members(spark: SparkSession, target: str, columns: list[str]) -> DataFrame:
    """Sketch the segments below ``target`` and keep the filters beside them."""
    path = f"{target.rstrip('/')}/{MEMBERS}"
    sketch = member_sketch(scan_segments(spark, target), columns)
    sketch.write.mode("overwrite").partitionBy("column_name").parquet(path)
    return read_members(spark, target)


def read_members(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target.rstrip('/')}/{MEMBERS}")


def member_segments(sketch: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``segment_id`` and ``WANTED`` of the segments that may hold the typed ``keys``; none that holds one is missing."""
    own = sketch.where(F.col("column_name") == column)
    bits = own.select("bits").first()
    if bits is None:
        return keys.select(F.lit(0).alias(SEGMENT), WANTED).limit(0)
    size = F.lit(bits[0]).cast("bigint")
    asked = keys.select(WANTED, F.explode(F.array_distinct(_positions(F.xxhash64(WANTED), size))).alias("place"))
    word, mask = _word(F.col("place"))
    asked = asked.select(WANTED, word.alias("word"), mask.alias("asked")).groupBy(WANTED, "word").agg(F.bit_or("asked").alias("asked"))
    words = F.count(F.lit(1)).alias("words")
    needed = asked.groupBy(WANTED).agg(words)
    met = asked.join(own, "word").where(F.col("mask").bitwiseAND(F.col("asked")) == F.col("asked"))
    met = met.groupBy(WANTED, SEGMENT).agg(words)
    same = F.col("n." + WANTED).eqNullSafe(F.col("m." + WANTED)) & (F.col("n.words") == F.col("m.words"))
    return met.alias("m").join(needed.alias("n"), same, "left_semi").select(SEGMENT, WANTED)


def prune_by_members(df: DataFrame, sketch: DataFrame, column: str, keys: DataFrame, key_column: str, segments: int) -> DataFrame:
    """Rows of a written folder whose ``column`` is one of ``keys.key_column``; only segments that may hold one are read."""
    value = F.col(quoted(column))
    typed = typed_keys(keys, key_column, df.select(value).schema[0].dataType).distinct()
    spark = df.sparkSession
    typed = scan(spark, stage(typed, fresh_path(spark, "keys"), "parquet"), "parquet", T.StructType(typed.schema.fields))
    ids = member_segments(sketch, column, typed).select(SEGMENT).distinct().where(F.col(SEGMENT).between(0, segments - 1))
    return read_segments(df, ids, segments).join(typed, value.eqNullSafe(F.col(WANTED)), "left_semi")
