"""Bringing rows to the declared table schema."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from segloom.functions.keys import quoted
from segloom.sources.formats import check_storage

# Milliseconds per unit of an epoch time format such as "1:SECONDS:EPOCH".
UNIT_MILLIS = {
    "MILLISECONDS": 1,
    "SECONDS": 1_000,
    "MINUTES": 60_000,
    "HOURS": 3_600_000,
    "DAYS": 86_400_000,
}


def project_physical(df: DataFrame, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """Keep the schema's columns, plus ``keep``; one that the data lacks becomes null.

    Names are matched as the session does, which ignores case unless told otherwise; the result has
    the schema's spelling.
    """
    return df.select(*_physical_columns(df, schema, keep))


def _physical_columns(df: DataFrame, schema: StructType, keep: list[str] | None) -> list[Column]:
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda name: name) if exact else str.lower
    present = {fold(name): name for name in df.columns}
    columns = [
        F.col(quoted(present[fold(f.name)])).alias(f.name)
        if fold(f.name) in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    declared = {fold(name) for name in schema.names}
    return [*columns, *[F.col(quoted(c)) for c in keep or [] if fold(c) not in declared]]


def conform_types(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Cast to the schema's types; a bad value fails the query, or becomes null if not strict."""

    def cast(field: StructField) -> Column:
        source = F.col(quoted(field.name))
        target = source.cast(field.dataType) if strict else source.try_cast(field.dataType)
        return target.alias(field.name, metadata=field.metadata)

    declared = {f.name: f for f in schema.fields}
    return df.select(*[cast(declared[c]) if c in declared else F.col(quoted(c)) for c in df.columns])


def conform(df: DataFrame, schema: StructType, keep: list[str] | None = None, strict: bool = True) -> DataFrame:
    return conform_types(project_physical(df, schema, keep), schema, strict)


REJECTED = "rejected"
REASONS = "reasons"
SOURCE_FILE = "source_file"
SOURCE_ROW = "source_row"


def with_reasons(df: DataFrame, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """The schema's columns, cast where possible, and ``reasons``: an entry for each value that could not be.

    An entry has the column's name, the value as text and the wanted type; a good row has none. ``source_file`` and
    ``source_row`` say where the row came from if ``df`` is a scan (Parquet only for the row).
    """
    taken = {c.lower() for c in (REASONS, REJECTED, SOURCE_FILE, SOURCE_ROW)}
    clash = sorted(c for c in [*schema.names, *(keep or [])] if c.lower() in taken)
    if clash:
        raise ValueError(f"columns {clash} have to be renamed")
    physical = project_physical(df, schema, keep)
    places = [_metadata(df, "file_path", "string").alias(SOURCE_FILE), _metadata(df, "row_index", "bigint").alias(SOURCE_ROW)]
    rows = df.select(*[c.alias(f"__{k}") for k, c in enumerate(_physical_columns(df, schema, keep))], *places)
    kinds = {f.name: f for f in schema.fields}
    casts, reasons = [], []
    for k, name in enumerate(physical.columns):
        value, field = F.col(f"__{k}"), kinds.get(name)
        if field is None:
            casts.append(value.alias(name))
            continue
        cast = value.try_cast(field.dataType)
        casts.append(cast.alias(name, metadata=field.metadata))
        text = value.cast("string") if rows.schema[f"__{k}"].dataType.simpleString() != "binary" else F.hex(value)
        reason = F.struct(F.lit(name).alias("column_name"), text.alias("value"), F.lit(field.dataType.simpleString()).alias("wanted"))
        reasons.append(F.when(value.isNotNull() & cast.isNull(), reason))
    return rows.select(*casts, F.array_compact(F.array(*reasons)).alias(REASONS), SOURCE_FILE, SOURCE_ROW)


def _metadata(df: DataFrame, name: str, kind: str) -> Column:
    """A field of a scan's file metadata, null where there is none."""
    try:
        known = df.select("_metadata").schema[0].dataType
    except AnalysisException:
        return F.lit(None).cast(kind)
    return F.col("_metadata").getField(name) if name in getattr(known, "names", []) else F.lit(None).cast(kind)


def part_rejects(df: DataFrame, schema: StructType, path: str, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows with the schema's types, and bad rows with their reasons and places; both from one pass over ``df``.

    The pass writes all rows below ``path``, good and bad ones apart. Good and bad rows together are the input's.
    """
    spark = df.sparkSession
    check_storage(spark, path)
    rows = with_reasons(df, schema, keep).withColumn(REJECTED, F.size(REASONS) > 0)
    rows.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    back = spark.read.schema(rows.schema).parquet(path)
    good = back.where(~F.col(REJECTED)).drop(REJECTED, REASONS, SOURCE_FILE, SOURCE_ROW)
    return good, back.where(F.col(REJECTED)).drop(REJECTED)


def event_time(field: StructField) -> Column:
    """Timestamp of a dateTime column, from the format in the field's metadata.

    ``1:SECONDS:EPOCH`` and its like are numbers since 1970; ``1:DAYS:SIMPLE_DATE_FORMAT:yyyyMMdd`` is a text
    (or a number that reads like one) in the session's time zone.
    """
    text = field.metadata.get("format", "")
    column = F.col(quoted(field.name))
    match = re.fullmatch(r"(\d+):([A-Z]+):EPOCH", text)
    if match is not None and match.group(2) in UNIT_MILLIS:
        return F.timestamp_millis(column * (int(match.group(1)) * UNIT_MILLIS[match.group(2)]))
    match = re.fullmatch(r"\d+:[A-Z]+:SIMPLE_DATE_FORMAT:(.+)", text)
    if match is not None:
        return F.to_timestamp(column.cast(StringType()), match.group(1))
    raise ValueError(f"column {field.name} has no epoch time format and no date pattern")


def granularity_millis(field: StructField) -> int:
    """Milliseconds of a dateTime column's granularity, such as ``15:MINUTES``."""
    match = re.fullmatch(r"(\d+):([A-Z]+)", field.metadata.get("granularity", ""))
    if match is None or match.group(2) not in UNIT_MILLIS or int(match.group(1)) < 1:
        raise ValueError(f"column {field.name} has no granularity")
    return int(match.group(1)) * UNIT_MILLIS[match.group(2)]


def bucket_number(field: StructField) -> Column:
    """Whole granules since 1970 of a dateTime column: neighbouring buckets have neighbouring numbers.

    As the key of ``modulo`` partitions, each partition holds whole buckets, and a zone map of the column
    tells time ranges apart.
    """
    millis, size = F.unix_millis(event_time(field)), granularity_millis(field)
    return F.floor((millis - F.pmod(millis, F.lit(size))) / F.lit(size)).cast("bigint")


def time_bucket(field: StructField) -> Column:
    """The beginning of the granule that a dateTime column's time lies in."""
    millis = F.unix_millis(event_time(field))
    return F.timestamp_millis(millis - F.pmod(millis, F.lit(granularity_millis(field))))
