"""Sketches by segment and column that merge over segments and runs without reading rows again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.functions.keys import quoted
from segloom.operators.assign import PID, SEGMENT

# 2**12 registers: a standard error of 1.6 % for distinct counts.
LOG_REGISTERS = 12
# Items a level keeps: a rank error of about 1.3 % at 99 % confidence.
QUANTILE_ITEMS = 200
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(name: str, kind: T.DataType) -> Column | None:
    """A value that quantiles can be taken of: numbers, and times as seconds since 1970."""
    value = F.col(quoted(name))
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, TIMES):
        return F.unix_micros(value.cast("timestamp")).cast("double") / 1e6
    return None


def _distinct(name: str, kind: T.DataType) -> Column:
    value = F.col(quoted(name))
    plain = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    return value if plain else F.to_json(F.struct(value)) if not isinstance(kind, T.AtomicType) else value.cast("string")


def segment_sketches(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per segment and column: rows, nulls, a sketch of distinct values and (numbers, times) one of quantiles.

    One pass; sketches are merged before the exchange and are of bounded size.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    columns = columns or [c for c in df.columns if c not in (PID, SEGMENT)]
    nothing = F.lit(None).cast("binary")

    def entry(name: str) -> Column:
        number = _number(name, kinds[name])
        value = F.col(quoted(name))
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(value.isNull()).alias("null_count"),
            F.hll_sketch_agg(_distinct(name, kinds[name]), F.lit(LOG_REGISTERS)).alias("distinct_sketch"),
            (nothing if number is None else F.kll_sketch_agg_double(number, F.lit(QUANTILE_ITEMS))).alias("quantile_sketch"),
        )

    wide = df.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("record_count"), *[entry(c).alias(f"c{k}") for k, c in enumerate(columns)])
    return wide.select(SEGMENT, "record_count", F.inline(F.array(*[f"c{k}" for k in range(len(columns))])))


def merge_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of all segments (and runs: give their union) per column, or per column and ``by``."""
    return sketches.groupBy(*(by or []), "column_name").agg(
        F.sum("record_count").alias("record_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def sketch_estimates(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """The sketches' columns with ``distinct_estimate`` and ``quantiles`` (an array in the order of ``ranks``)."""
    filled = F.col("quantile_sketch").isNotNull() & (F.coalesce(F.kll_sketch_get_n_double("quantile_sketch"), F.lit(0)) > 0)
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(r))) for r in ranks])
    estimated = sketches.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_sketch"))
    return estimated.withColumn("quantiles", F.when(filled, quantiles)).drop("distinct_sketch", "quantile_sketch")
