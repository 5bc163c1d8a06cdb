"""Assigning rows to partition ids and segment ids.

With S segments and P partitions there are three cases:

* no key column: every row goes to segment 0;
* S <= P: ``segment = pid % S``, a plain expression without any shuffle;
* S > P: each partition owns a block of neighbouring segments and deals its rows to them in
  turn, in the order of a unique ``order_by`` key. This one needs each row's rank within its
  partition.

The rank never gathers a partition in one task unless the table is small. Otherwise one range exchange
puts all rows in the order of (partition id, order key), in tasks of about ``rows_per_cell`` rows
(*cells*), whatever the skew of the partition key and however it goes along with the order. If that would take
more than ``MANY_TASKS`` tasks, cells are larger, up to ``ROWS_PER_CELL`` rows: every task costs the driver 300 sampled
keys and its own report. Copies of a row
are told apart by where they were read, so they are cut like any others. The ordered rows are written once;
the rows of each partition id in each cell are counted, running totals of these few counts say where a cell's
first row ranks, and a row's rank is that plus its place in the cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from segloom.functions.hashing import PARTITION_FUNCTIONS, partition_function_name
from segloom.functions.keys import partition_key, quoted
from segloom.functions.staged import TEMP, staged_form
from segloom.session import fresh_path, materialise
from segloom.sources.schema import PartitionSpec

PID = "pid"
SEGMENT = "segment_id"

# A task sorts about this many rows; the sort spills, so it bounds time rather than memory.
ROWS_PER_CELL = 1_000_000
# Characters of a text that the ranges of the exchange are cut by: more where texts begin alike.
KEY_LENGTHS = (64, 256, 1024, 4096)
# Rows that are looked at for texts that begin alike.
SAMPLE = 20_000
# Spark's sample of range keys comes to the driver: this many rows a task, and a million in all at most.
KEYS_PER_TASK, MOST_KEYS = 100, 1_000_000
# Characters of texts among them, in all.
KEY_ROOM = 1 << 27
# So many tasks are enough for cells of fewer than ROWS_PER_CELL rows; more rows make the cells larger.
MANY_TASKS = 1_000
# Most tasks of the one exchange of all rows; beyond it they grow and spill.
MAX_TASKS = 50_000
# Counts of cells and partition ids that are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 1_000_000


def with_partition_id(
    df: DataFrame, column: str | None, function: str | None, partitions: int, name: str = PID
) -> DataFrame:
    """Add the partition id of ``column``; without a column it is 0."""
    _require_free(df, name)
    partitions = max(partitions, 1)
    if column is None:
        return df.withColumn(name, F.lit(0))
    function = partition_function_name(function)
    # the staged forms use helper columns; rows that have such names take the plain form
    clash = any(c.lower().startswith(TEMP) for c in df.columns)
    staged = None if clash else staged_form(df, column, function)
    if staged is not None:
        return staged(df, column, partitions, name)
    return df.withColumn(name, PARTITION_FUNCTIONS[function](partition_key(F.col(quoted(column))), partitions))


@dataclass(frozen=True)
class SegmentBlocks:
    """Which segments each partition owns when S >= P: ``[first, first + size)``."""

    partitions: int
    segments: int

    def size(self, pid: Column) -> Column:
        base, extra = divmod(self.segments, self.partitions)
        return F.when(pid < extra, base + 1).otherwise(base).cast("int")

    def first(self, pid: Column) -> Column:
        base, extra = divmod(self.segments, self.partitions)
        return (pid * base + F.least(pid, F.lit(extra))).cast("int")


def segment_range(pid: Column, spec: PartitionSpec) -> tuple[Column, Column]:
    """First segment of ``pid`` and the one after its last."""
    if spec.column is None:
        return F.lit(0), F.lit(1)
    if not spec.spreads:
        first = (pid % spec.segment_count).cast("int")
        return first, first + 1
    blocks = SegmentBlocks(spec.partition_count, spec.segment_count)
    return blocks.first(pid), blocks.first(pid) + blocks.size(pid)


def assign_segments(
    df: DataFrame,
    spec: PartitionSpec,
    order_by: list[str] | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    unique: bool = False,
    staging: str | None = None,
) -> DataFrame:
    """Add ``pid`` and ``segment_id``.

    For S > P rows are dealt in the order of ``order_by`` (which may be empty) and then of a hash of all
    columns; rows that are equal in both are copies of one another. ``unique`` promises that ``order_by``
    alone tells all rows apart, which spares reading and hashing the other columns. ``df`` is read more
    than once, so it should be a staged table rather than a long query. A table of more than ``rows_per_cell`` rows
    is put in order and written once, at ``staging``, which the result reads. Which cells it is cut into changes nothing
    in the result.
    """
    _require_free(df, SEGMENT)
    if not spec.spreads:
        first, _ = segment_range(F.col(PID), spec)
        return _routed(df, spec).withColumn(SEGMENT, first)
    if order_by is None:
        raise ValueError("more segments than partitions: order_by has to name the columns to deal by")
    blocks = SegmentBlocks(spec.partition_count, spec.segment_count)
    ranked, rank = with_partition_rank(df, spec, order_by, rows_per_cell, unique, staging)
    turn = (F.col(rank) % blocks.size(F.col(PID))).cast("int")
    return ranked.withColumn(SEGMENT, blocks.first(F.col(PID)) + turn).drop(rank)


def _require_free(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the rows already have a column {name}; rename it in the query")


def _routed(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    return with_partition_id(df, spec.column, spec.function, spec.partition_count)


@dataclass(frozen=True)
class Names:
    """Helper columns under names that the rows do not have."""

    rank: str
    cell: str
    nth: str
    tie: str
    place: str
    before: str

    @staticmethod
    def beside(df: DataFrame) -> Names:
        mark = "__"
        while any(c.lower().startswith(mark) for c in df.columns):
            mark += "_"
        return Names(*(f"{mark}{n}" for n in ("rank", "cell", "nth", "tie", "place", "before")))


def with_partition_rank(
    df: DataFrame,
    spec: PartitionSpec,
    order_by: list[str],
    rows_per_cell: int = ROWS_PER_CELL,
    unique: bool = False,
    staging: str | None = None,
) -> tuple[DataFrame, str]:
    """``df`` with ``pid`` and the 0-based rank of each row within it, and the name of the rank column.

    The order is one and the same however many cells there are: ``order_by``, then the hash of all columns. The
    ordered rows of a table of several cells lie at ``staging`` (by default in a new place of the shared folder).
    """
    names = Names.beside(df)
    columns = [quoted(c) for c in df.columns]
    order = [quoted(c) for c in order_by]
    # Without a filter this reads file footers only.
    total = df.count()
    rows = _routed(df, spec)
    if not unique:
        rows = rows.withColumn(names.tie, _content_hash(df))
        order = [*order, names.tie]
    if total <= rows_per_cell:
        rank = F.row_number().over(Window.partitionBy(PID).orderBy(*order)) - 1
        # Rows that tie in all of ``order`` are copies of each other, so a retry that swaps them changes nothing.
        return rows.withColumn(names.rank, rank.cast("long")).select(*columns, PID, names.rank), names.rank

    spark, tasks = df.sparkSession, exchange_tasks(df, cell_count(total, rows_per_cell))
    rows_per_cell = max(rows_per_cell, -(-total // tasks))
    rows = rows.withColumn(names.place, F.monotonically_increasing_id())
    keys = _range_keys(rows, [*order, names.place], total, rows_per_cell, tasks)
    ordered = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(PID, *order, names.place)
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.select(*columns, PID, F.spark_partition_id().alias(names.cell), nth.alias(names.nth))
    path = staging or fresh_path(spark, "dealt")
    ordered.write.mode("overwrite").parquet(path)
    ordered = spark.read.schema(ordered.schema).parquet(path)
    counts = ordered.groupBy(PID, names.cell).agg(F.count(F.lit(1)).alias("n"), F.min(names.nth).alias("first"))
    before = Window.partitionBy(PID).orderBy(names.cell).rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition id and one more per cell: what a cell's places have to be moved by
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    shifts = materialise(counts.select(PID, names.cell, shift.alias(names.before)))
    if spec.partition_count + tasks <= BROADCAST_CELLS:
        shifts = F.broadcast(shifts)
    joined = ordered.join(shifts, [PID, names.cell])
    return joined.withColumn(names.rank, F.col(names.nth) + F.col(names.before)).select(*columns, PID, names.rank), names.rank


def _content_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[_hashable(f) for f in df.schema.fields])


def _hashable(field: T.StructField) -> Column:
    column = F.col(quoted(field.name))
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def _range_keys(rows: DataFrame, order: list[str], total: int, rows_per_cell: int, tasks: int) -> list[Column]:
    """Keys that put rows in the order of (pid, ``order``), with texts cut so that the driver's sample stays small.

    After a cut text come whether it was longer and, if not, the columns behind it: rows whose longer texts begin
    alike are not told apart any further and share a cell, in which they are sorted by their whole texts.
    """
    keys, whole = [F.col(PID)], None

    def known(column: Column) -> Column:
        return column if whole is None else F.when(whole, column)

    for name in order:
        column = F.col(name)
        if isinstance(rows.select(name).schema[0].dataType, (T.StringType, T.BinaryType)):
            length = _key_length(rows, name, total, rows_per_cell, tasks)
            fits = F.coalesce(F.length(column) <= length, F.lit(True))
            keys += [known(F.substring(column, 1, length)), known(~fits)]
            whole = fits if whole is None else whole & fits
        else:
            keys.append(known(column))
    return keys


def _key_length(rows: DataFrame, name: str, total: int, rows_per_cell: int, tasks: int) -> int:
    """How much of a text tells rows apart well enough, within the room that the driver's sample has."""
    room = KEY_ROOM // min(KEYS_PER_TASK * tasks, MOST_KEYS)
    lengths = [n for n in KEY_LENGTHS if n <= max(room, KEY_LENGTHS[0])]
    fraction = min(1.0, SAMPLE / total)
    sample = materialise(rows.where(F.length(name) > lengths[0]).sample(fraction, seed=0).select(PID, F.substring(F.col(name), 1, lengths[-1]).alias("text")))
    for length in lengths:
        same = sample.groupBy(PID, F.substring("text", 1, length)).count()
        if (same.agg(F.max("count")).first()[0] or 0) <= max(rows_per_cell * fraction, 2):
            return length
    return lengths[-1]


def cell_count(total: int, rows_per_cell: int) -> int:
    """Cells of about ``rows_per_cell`` rows; beyond ``MANY_TASKS`` no more than of ``ROWS_PER_CELL`` rows."""
    return min(-(-total // rows_per_cell), max(-(-total // ROWS_PER_CELL), MANY_TASKS))


def exchange_tasks(df: DataFrame, wanted: int) -> int:
    """Tasks of an exchange: at least the session's setting, more for more data."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, min(wanted, MAX_TASKS))
