"""Turning a key column into the text that the partition functions see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def quoted(column: str) -> str:
    """The name as one identifier, dots included."""
    return "`" + column.replace("`", "``") + "`"


def partition_key(key: Column) -> Column:
    """Key text; a null key routes like the empty string."""
    return F.coalesce(key.cast("string"), F.lit(""))


def is_integral(df: DataFrame, column: str) -> bool:
    """True when ``column`` is a plain whole-number column of ``df``."""
    return isinstance(df.select(F.col(quoted(column))).schema[0].dataType, INTEGRAL_TYPES)
