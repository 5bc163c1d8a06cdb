"""Counts, sizes and checks over assigned or written segments.

Every aggregate here combines on the map side and ends in one row per segment (or per
segment and column), so none of them moves the rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.operators.assign import PID, SEGMENT, segment_range
from segloom.operators.prune import scan_segments
from segloom.operators.sink import segment_name, segment_uri
from segloom.sources.scan import input_file_stats, input_files
from segloom.sources.schema import PartitionSpec


def input_record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("input_record_count"))


def segment_record_count(df: DataFrame) -> DataFrame:
    return df.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("record_count"))


def segment_byte_size(spark: SparkSession, target: str) -> DataFrame:
    """Stored bytes and files per segment, from a listing."""
    segment = F.regexp_extract("path", f"/{SEGMENT}=(\\d+)/", 1).cast("int")
    return (
        input_files(spark, target)
        .groupBy(segment.alias(SEGMENT))
        .agg(F.sum("length").alias("byte_size"), F.count(F.lit(1)).alias("file_count"))
    )


def all_segments(spark: SparkSession, segments: int) -> DataFrame:
    return spark.range(segments).select(F.col("id").cast("int").alias(SEGMENT))


def emit_empty_segments(counts: DataFrame, segments: int) -> DataFrame:
    """One row per id in ``[0, segments)``; the measures of ids without rows become 0."""
    return all_segments(counts.sparkSession, segments).join(counts, SEGMENT, "left").na.fill(0)


def segment_manifest(
    spark: SparkSession, target: str, table: str, segment_key: str, segments: int
) -> DataFrame:
    """One row per segment of a written folder: name, location, rows, bytes, files.

    Counted from what was written, so that task retries during the write cannot skew it.
    The scan needs no column but the directory's, hence only file footers are read. The
    location of an empty segment holds no file.
    """
    # A declared schema needs no file to infer it from: a run may have written none.
    rows = scan_segments(spark, target, schema=T.StructType().add(SEGMENT, T.IntegerType()))
    # one pass: a file's length comes with its rows, and each file has some
    files = rows.groupBy(SEGMENT, F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_metadata.file_size").alias("length")
    )
    measures = files.groupBy(SEGMENT).agg(
        F.sum("n").alias("record_count"), F.sum("length").alias("byte_size"), F.count(F.lit(1)).alias("file_count")
    )
    segment = F.col(SEGMENT)
    return emit_empty_segments(measures, segments).select(
        SEGMENT,
        segment_name(table, segment_key, segment).alias("segment_name"),
        segment_uri(target, segment).alias("segment_uri"),
        "record_count",
        "byte_size",
        "file_count",
    )


def generation_summary(
    manifest: DataFrame, source: DataFrame, source_path: str | None = None, read: int | None = None
) -> DataFrame:
    """One row: segments, rows and bytes written, and the input they came from; ``read`` if already counted."""
    written = manifest.agg(
        F.count(F.lit(1)).alias("segment_count"),
        F.sum("record_count").alias("record_count"),
        F.sum("byte_size").alias("byte_size"),
    )
    summary = written.withColumn(
        "input_record_count", input_record_count(source).scalar() if read is None else F.lit(read).cast("bigint")
    )
    if source_path is None:
        return summary
    size = input_file_stats(manifest.sparkSession, source_path).select("byte_size").scalar()
    return summary.withColumn("input_byte_size", size)


def reconcile(source: DataFrame, counts: DataFrame) -> DataFrame:
    """One row comparing the rows read with the rows found in the segments."""
    return counts.agg(F.coalesce(F.sum("record_count"), F.lit(0)).alias("output_record_count")).select(
        input_record_count(source).scalar().alias("input_record_count"),
        "output_record_count",
        (F.col("input_record_count") == F.col("output_record_count")).alias("matched"),
    )


def require_reconciled(source: DataFrame, counts: DataFrame, read: int | None = None) -> tuple[int, int]:
    """Input and output rows; fails when they differ.

    ``read`` are rows that the writing pass saw; the source is counted only if they are unknown or do not agree
    (a task that ran twice may have counted twice).
    """
    if read is not None:
        written = counts.agg(F.coalesce(F.sum("record_count"), F.lit(0)).alias("n")).first().n
        if written == read:
            return read, written
    row = reconcile(source, counts).first()
    if not row.matched:
        raise RuntimeError(f"read {row.input_record_count} rows but wrote {row.output_record_count}")
    return row.input_record_count, row.output_record_count


def segment_column_stats(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Per segment and column: rows, nulls, distinct values, least and greatest value as text.

    By default distinct values are estimated in the same single pass. ``exact`` counts them by
    first reducing to distinct (segment, column, value) triples, which combines on the map
    side: a value that fills a third of the rows leaves each task once.
    """
    columns = columns or [c for c in df.columns if c not in (PID, SEGMENT)]
    measures = [_column_measures(df, c, estimate=not exact).alias(f"s{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("record_count"), *measures)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}.*")) for i, c in enumerate(columns)]
    stats = wide.select(SEGMENT, "record_count", F.inline(F.array(*entries)))
    if not exact:
        return stats
    counted = stats.join(_distinct_counts(df, columns), [SEGMENT, "column_name"], "left")
    return counted.select(*stats.columns, F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"))


def _kind(df: DataFrame, name: str) -> tuple[bool, bool]:
    """Whether a column is nested, and whether its values have an order of their own."""
    data_type = df.schema[name].dataType
    nested = isinstance(data_type, T.ArrayType | T.StructType | T.MapType | T.VariantType)
    return nested, not nested or not any(k in data_type.simpleString() for k in ("map<", "variant"))


def _column_measures(df: DataFrame, name: str, estimate: bool) -> Column:
    nested, ordered = _kind(df, name)
    text = F.to_json(name) if nested else F.col(name)
    value = F.col(name) if ordered else text

    def shown(extreme: Column) -> Column:
        return F.to_json(extreme) if nested and ordered else extreme.cast("string")

    measures = [
        shown(F.min(value)).alias("min_value"),
        shown(F.max(value)).alias("max_value"),
        F.count_if(F.col(name).isNull()).alias("null_count"),
    ]
    if estimate:
        measures.append(F.approx_count_distinct(text).alias("distinct_count"))
    return F.struct(*measures)


def _distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    def entry(name: str) -> Column:
        value = F.to_json(name) if _kind(df, name)[0] else F.col(name).cast("string")
        return F.struct(F.lit(name).alias("column_name"), value.alias("value"))

    values = df.select(SEGMENT, F.inline(F.array(*[entry(c) for c in columns])))
    triples = values.where(F.col("value").isNotNull()).distinct()
    return triples.groupBy(SEGMENT, "column_name").agg(F.count(F.lit(1)).alias("distinct_count"))


def segment_time_range(df: DataFrame, time: Column) -> DataFrame:
    """First and last event time per segment."""
    return df.groupBy(SEGMENT).agg(F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def segment_balance(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """One row per partition id: how evenly its rows fill the segments it owns.

    ``largest_share`` is the fullest segment's size in units of rows / S.
    """
    per_segment = df.groupBy(PID, SEGMENT).agg(F.count(F.lit(1)).alias("n"))
    first, end = segment_range(F.col(PID), spec)
    total = per_segment.agg(F.sum("n")).scalar()
    owned = end - first
    return (
        per_segment.groupBy(PID)
        .agg(
            F.sum("n").alias("record_count"),
            F.count(F.lit(1)).alias("used_segments"),
            F.min("n").alias("least"),
            F.max("n").alias("most"),
        )
        .select(
            PID,
            "record_count",
            owned.alias("owned_segments"),
            "used_segments",
            F.when(F.col("used_segments") < owned, 0).otherwise(F.col("least")).alias("min_records"),
            F.col("most").alias("max_records"),
            (F.col("most") - F.when(F.col("used_segments") < owned, 0).otherwise(F.col("least"))).alias("spread"),
            (F.col("most") * spec.segment_count / total).alias("largest_share"),
        )
    )


def segment_fill(df: DataFrame, segments: int) -> DataFrame:
    """Segment ids that received no row."""
    used = df.select(SEGMENT).distinct()
    return all_segments(df.sparkSession, segments).join(used, SEGMENT, "left_anti")


def segment_purity(df: DataFrame) -> DataFrame:
    """Distinct partition ids per segment; 1 everywhere when S >= P."""
    pairs = df.select(SEGMENT, PID).distinct()
    return pairs.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("partition_ids"))
