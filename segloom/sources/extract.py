"""Running the user's query and staging its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segloom.sources.formats import JSON_WRITE_OPTIONS, check_storage, stageable_format

PARQUET_CODEC = "snappy"


def extract(spark: SparkSession, query: str) -> DataFrame:
    """Result of the user's SQL text over the session's tables and views."""
    if not query or not query.strip():
        raise ValueError("a query is required")
    return spark.sql(query.strip().rstrip(";"))


def stage(df: DataFrame, destination: str, fmt: str) -> str:
    """Write ``df`` to ``destination`` as JSON lines or Parquet and return the path."""
    if not destination or not destination.strip():
        raise ValueError("a destination is required")
    fmt = stageable_format(fmt)
    check_storage(df.sparkSession, destination)
    path = destination.strip().rstrip("/")
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer.options(**JSON_WRITE_OPTIONS).json(path)
    else:
        writer.option("compression", PARQUET_CODEC).parquet(path)
    return path
