"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.session import fresh_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: The ASCII white space characters, [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"


#: Paths of the tables that are staged within each open ``scratch``.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what is staged within, at the end; no frame that reads it may be used after that."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield
    finally:
        _scratch.pop()
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, uri: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that no executor holds the only copy."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if _scratch:
        _scratch[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package wherever the driver was started from."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
    return spark


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``row`` (all columns), ``id`` and ``text`` (null: empty), whatever else the input's columns are called."""
    return docs.select(
        F.struct("*").alias("row"),
        F.col(quoted(id_column)).cast("bigint").alias("id"),
        text_or_empty(text_column).alias("text"),
    )


def unpacked(df: DataFrame, *outputs: str) -> DataFrame:
    """The input's columns and then ``outputs``; an input column with an output's name gives way."""
    taken = {name.lower() for name in outputs}
    names = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row").getField(name).alias(name) for name in names], *outputs)


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32 of the id as text leaves ``remainder``."""
    return (F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus) == remainder


def lists(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each batch as Python lists."""
    for batch in batches:
        yield tuple(batch.column(name).to_pylist() for name in names)
