"""File formats that can be staged and scanned, and the storage schemes behind a URI."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

READABLE = ("avro", "parquet", "json")
STAGEABLE = ("json", "parquet")

# Spark's default JSON time format stops at milliseconds. Null fields are written out.
JSON_WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def readable_format(name: str) -> str:
    """Canonical name of an input format."""
    return _known(name)


def stageable_format(name: str) -> str:
    """Canonical name of a format that a query result can be staged in."""
    fmt = _known(name)
    if fmt not in STAGEABLE:
        raise NotImplementedError(f"a query result cannot be staged as {fmt}")
    return fmt


def writable_format(spark: SparkSession, name: str) -> str:
    """Canonical name of a format that rows can be routed to; Avro needs the spark-avro module."""
    fmt = _known(name)
    if fmt == "avro" and not has_avro(spark):
        raise NotImplementedError("writing Avro needs the spark-avro module on the session's classpath")
    return fmt


def _known(name: str) -> str:
    if not name or not name.strip():
        raise ValueError("a format is required")
    fmt = name.strip().lower()
    if fmt not in READABLE:
        raise ValueError(f"unknown format {name}, expected one of {READABLE}")
    return fmt


def has_avro(spark: SparkSession) -> bool:
    """Whether the external spark-avro module is on the classpath."""
    try:
        spark.read.format("avro").schema("probe int").load([])
    except AnalysisException:
        return False
    return True


def storage_scheme(uri: str) -> str:
    """Lower-case scheme of a storage URI; none means the local file system."""
    return urlsplit(uri).scheme.lower() or "file"


def check_storage(spark: SparkSession, uri: str) -> str:
    """The scheme of ``uri`` if this session has a file system for it, else an error."""
    scheme = storage_scheme(uri)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        jvm.org.apache.hadoop.fs.FileSystem.getFileSystemClass(scheme, conf)
    except Exception as missing:
        raise ValueError(f"no file system for scheme {scheme!r} in this session") from missing
    return scheme
