"""Zone maps: the least and greatest value of columns in each segment, and which segments a condition can hold in.

A zone map has one row per segment and lies beside the segments. A condition is evaluated on it with SQL's three
values: for every part it is known whether some row of a segment can make it true, and whether some row can
make it false; rows that make it neither (null) count for none. Negation swaps the two.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.functions.keys import quoted
from segloom.operators.assign import PID, SEGMENT
from segloom.operators.prune import _literal, read_segments, scan_segments

# Characters of a text that a zone map keeps. A longer greatest value has no upper bound.
TEXT_LENGTH = 64
ZONES = "_zones"
ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
COMPARISONS = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def zone_map(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``segment_id``, ``record_count`` and ``zones``: per column its ``least`` and ``most`` value and ``nulls``.

    Without ``columns`` all that have an order. One pass, combined before the exchange.
    """
    known = {f.name: f.dataType for f in df.schema.fields if f.name not in (PID, SEGMENT)}
    names = columns or [n for n, kind in known.items() if isinstance(kind, ORDERED)]
    wrong = [n for n in names if not isinstance(known.get(n), ORDERED)]
    if wrong:
        raise ValueError(f"no order to index by: {wrong}")

    def zone(name: str) -> Column:
        value = F.col(quoted(name))
        least, most = F.min(value), F.max(value)
        if isinstance(known[name], T.StringType):
            most = F.when(F.char_length(most) <= TEXT_LENGTH, most)
            least = F.substring(least, 1, TEXT_LENGTH)
        return F.struct(least.alias("least"), most.alias("most"), F.count_if(value.isNull()).alias("nulls")).alias(name)

    return df.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("record_count"), F.struct(*map(zone, names)).alias("zones"))


def write_zones(spark: SparkSession, target: str, columns: list[str] | None = None) -> DataFrame:
    """Index the segments below ``target`` and keep the zone map beside them."""
    path = f"{target.rstrip('/')}/{ZONES}"
    zone_map(scan_segments(spark, target), columns).write.mode("overwrite").parquet(path)
    return read_zones(spark, target)


def read_zones(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target.rstrip('/')}/{ZONES}")


class Condition:
    """A condition on rows that can also be asked of a zone map."""

    def rows(self, kinds: T.StructType) -> Column:
        """The condition on a row."""
        raise NotImplementedError

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        """Whether a row of the segment can make it true, and whether one can make it false."""
        raise NotImplementedError

    def __and__(self, other: Condition) -> Condition:
        return Every(self, other)

    def __or__(self, other: Condition) -> Condition:
        return Some(self, other)

    def __invert__(self) -> Condition:
        return Not(self)


def _zone(column: str) -> tuple[Column, Column, Column, Column]:
    """Least and greatest value, whether there are values, whether there are nulls."""
    zone = F.col("zones").getField(column)
    nulls = zone.getField("nulls")
    return zone.getField("least"), zone.getField("most"), F.col("record_count") > nulls, nulls > 0


def _sure(test: Column, otherwise: bool) -> Column:
    return F.coalesce(test, F.lit(otherwise))


@dataclass(frozen=True)
class Compare(Condition):
    """``column`` compared with a value; a null value is never true nor false."""

    column: str
    sign: str
    value: Any

    def _value(self, kinds: T.StructType) -> Column:
        kind = kinds[self.column].dataType
        literal = F.lit(_literal(self.value))
        number = isinstance(self.value, (int, float)) and not isinstance(self.value, bool)
        # numbers of any kind keep their order when compared; all else is brought to the column's type
        return literal if number and isinstance(kind, T.NumericType) else literal.cast(kind)

    def rows(self, kinds: T.StructType) -> Column:
        return COMPARISONS[self.sign](F.col(quoted(self.column)), self._value(kinds))

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        if self.value is None:
            return F.lit(False), F.lit(False)
        least, most, filled, _ = _zone(self.column)
        value = self._value(kinds)
        if self.sign == "=":
            true = (least <= value) & _sure(most >= value, True)
            return filled & true, filled & ~_sure((least == most) & (least == value), False)
        below, above = {"<": (True, False), "<=": (True, True), ">": (False, True), ">=": (False, False)}[self.sign]
        # values below the bound (or up to it), and values above it (or from it on)
        low = least <= value if above else least < value
        high = _sure(most > value, True) if above else _sure(most >= value, True)
        return (filled & low, filled & high) if below else (filled & high, filled & low)


@dataclass(frozen=True)
class Missing(Condition):
    """``column`` is null."""

    column: str

    def rows(self, kinds: T.StructType) -> Column:
        return F.col(quoted(self.column)).isNull()

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        _, _, filled, nulls = _zone(self.column)
        return nulls, filled


class Every(Condition):
    """All parts are true."""

    def __init__(self, *parts: Condition):
        self.parts = parts

    def rows(self, kinds: T.StructType) -> Column:
        return reduce(operator.and_, [p.rows(kinds) for p in self.parts])

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        asked = [p.zones(kinds) for p in self.parts]
        return reduce(operator.and_, [t for t, _ in asked]), reduce(operator.or_, [f for _, f in asked])


class Some(Condition):
    """One part is true."""

    def __init__(self, *parts: Condition):
        self.parts = parts

    def rows(self, kinds: T.StructType) -> Column:
        return reduce(operator.or_, [p.rows(kinds) for p in self.parts])

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        asked = [p.zones(kinds) for p in self.parts]
        return reduce(operator.or_, [t for t, _ in asked]), reduce(operator.and_, [f for _, f in asked])


@dataclass(frozen=True)
class Not(Condition):
    """The part is false."""

    part: Condition

    def rows(self, kinds: T.StructType) -> Column:
        return ~self.part.rows(kinds)

    def zones(self, kinds: T.StructType) -> tuple[Column, Column]:
        true, false = self.part.zones(kinds)
        return false, true


def among(column: str, values: list) -> Condition:
    return Some(*[Compare(column, "=", v) for v in values])


def between(column: str, low: Any, high: Any) -> Condition:
    """``low <= column < high``."""
    return Every(Compare(column, ">=", low), Compare(column, "<", high))


def zone_segments(zones: DataFrame, condition: Condition, kinds: T.StructType) -> DataFrame:
    """Ids of the segments in which a row can make the condition true."""
    return zones.where(condition.zones(kinds)[0]).select(SEGMENT)


def prune_by_zones(df: DataFrame, zones: DataFrame, condition: Condition, segments: int) -> DataFrame:
    """Rows of a written folder that make the condition true; other segments' files are not opened."""
    return read_segments(df, zone_segments(zones, condition, df.schema), segments).where(condition.rows(df.schema))
