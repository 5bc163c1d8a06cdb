"""Properties of segment assignment on the reference's grid of (P, S)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segloom.operators import assign
from segloom.operators.assign import SegmentBlocks, assign_segments, segment_range
from segloom.operators.manifest import segment_balance, segment_fill, segment_purity
from segloom.session import fresh_path
from segloom.sources.schema import PartitionSpec


def users(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("user-"), F.col("id"), F.lit("-key")).alias("k"))


def spec(p, s, function="murmur", column="k"):
    return PartitionSpec(column, function, p, s)


@pytest.mark.parametrize("p, s", [(4, 4), (8, 3), (3, 8), (1, 5), (5, 1), (16, 16), (10, 7), (7, 10), (8, 32)])
def test_segment_in_range_and_inside_its_block(spark, p, s):
    assigned = assign_segments(users(spark, 5000), spec(p, s), ["id"])
    first, end = segment_range(F.col("pid"), spec(p, s))
    outside = assigned.where(
        ~F.col("segment_id").between(0, s - 1) | (F.col("segment_id") < first) | (F.col("segment_id") >= end)
    )
    assert assigned.count() == 5000
    assert outside.count() == 0


def test_equal_counts_are_the_identity(spark):
    assert assign_segments(users(spark, 2000), spec(8, 8)).where("pid <> segment_id").count() == 0


def test_fewer_segments_fold_by_remainder(spark):
    assert assign_segments(users(spark, 2000), spec(12, 5)).where("pid % 5 <> segment_id").count() == 0


def test_without_column_everything_is_in_segment_0(spark):
    assigned = assign_segments(users(spark, 100), spec(1, 4, None, None))
    assert [tuple(r) for r in assigned.groupBy("pid", "segment_id").count().collect()] == [(0, 0, 100)]


@pytest.mark.parametrize("p, s", [(3, 8), (8, 32), (2, 5), (8, 9)])
def test_one_partition_id_per_segment(spark, p, s):
    assigned = assign_segments(users(spark, 20000), spec(p, s), ["id"])
    assert {r.partition_ids for r in segment_purity(assigned).collect()} == {1}


@pytest.mark.parametrize("p, s", [(3, 8), (8, 32), (2, 5), (12, 5), (8, 9)])
def test_every_segment_filled(spark, p, s):
    assert segment_fill(assign_segments(users(spark, 100000), spec(p, s), ["id"]), s).count() == 0


def test_balance_with_the_worst_keys_for_hashcode(spark):
    df = spark.range(200000).select((F.col("id") + 100000000).alias("k"))
    counts = assign_segments(df, spec(8, 32, "hashcode"), ["k"]).groupBy("segment_id").count().collect()
    assert len(counts) == 32
    assert all(0.85 < r["count"] / (200000 / 32) < 1.15 for r in counts)


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 5_000])
def test_spread_within_a_partition_is_at_most_one(spark, rows_per_cell):
    assigned = assign_segments(users(spark, 240000), spec(4, 12), ["id"], rows_per_cell)
    balance = segment_balance(assigned, spec(4, 12)).collect()
    assert len(balance) == 4
    assert all(r.spread <= 1 and r.used_segments == 3 for r in balance)


def expected_turns(df, p, s, order_by):
    blocks = SegmentBlocks(p, s)
    rank = F.row_number().over(Window.partitionBy("pid").orderBy(*order_by)) - 1
    return df.withColumn("want", blocks.first(F.col("pid")) + rank % blocks.size(F.col("pid")))


@pytest.mark.parametrize("order_by", [["o_orderkey"], ["o_orderstatus", "o_orderdate", "o_orderkey"]])
def test_cells_give_the_same_rows_as_one_window(spark, data, order_by):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    cut = assign_segments(orders, spec(4, 13, "modulo", "o_orderkey"), order_by, rows_per_cell=25)
    assert cut.count() == orders.count()
    assert expected_turns(cut, 4, 13, order_by).where("want <> segment_id").count() == 0


def test_a_hot_partition_is_cut_into_cells(spark):
    # Half of all rows share one key.
    df = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assigned = assign_segments(df, spec(4, 12), ["id"], rows_per_cell=500)
    assert assigned.count() == 20000
    assert all(r.spread <= 1 for r in segment_balance(assigned, spec(4, 12)).collect())


def test_equal_order_keys_and_copies_are_cut_too(spark):
    # A third of the rows are copies of one row, so their order key cannot separate them.
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assigned = assign_segments(df, spec(4, 12, "modulo"), ["k"], rows_per_cell=100)
    assert assigned.columns == ["k", "pid", "segment_id"]
    assert assigned.count() == 9000
    assert all(r.spread <= 1 for r in segment_balance(assigned, spec(4, 12)).collect())


def test_null_order_keys_are_kept(spark):
    df = users(spark, 4000).withColumn("o", F.when(F.col("id") % 10 > 0, F.col("id")))
    assigned = assign_segments(df, spec(2, 6), ["o", "id"], rows_per_cell=200)
    assert assigned.count() == 4000
    assert all(r.spread <= 1 for r in segment_balance(assigned, spec(2, 6)).collect())


def test_more_segments_than_partitions_need_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        assign_segments(users(spark, 10), spec(2, 4))


def test_ordered_rows_are_ranked_without_another_shuffle(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    cut = assign_segments(orders, spec(4, 12, "modulo", "o_orderkey"), ["o_orderkey"], rows_per_cell=100)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line] == []
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def fullest(spark, rows, by, order_by, rows_per_cell):
    """Rows of the fullest cell, and whether rows were dealt as by one window."""
    path = fresh_path(spark, "dealt")
    cut = assign_segments(rows, by, order_by, rows_per_cell, staging=path)
    cells = spark.read.parquet(path).groupBy("__cell").count().agg(F.max("count")).first()[0]
    same = cut.exceptAll(assign_segments(rows, by, order_by, 10**9)).count() == 0
    return cells, same and cut.count() == rows.count()


def test_copies_and_texts_that_begin_alike_fill_no_cell(spark):
    by = PartitionSpec("k", "hashcode", 2, 6)
    one = spark.range(20_000).select(F.lit("x").alias("k"), F.lit("the same text").alias("t"))
    most, same = fullest(spark, one, by, ["t"], 1000)
    assert same and most <= 4 * 1000
    alike = spark.range(20_000).select(F.lit("x").alias("k"), F.concat(F.repeat(F.lit("a"), F.lit(100)), F.sha2(F.col("id").cast("string"), 256)).alias("t"), "id")
    most, same = fullest(spark, alike, by, ["t", "id"], 1000)
    assert same and most <= 4 * 1000
    # short texts, longer ones and nulls, equal ones told apart by the column behind them
    mixed = spark.range(20_000).selectExpr("'x' AS k", "CASE WHEN id % 4 = 0 THEN 'short' WHEN id % 4 = 1 THEN NULL WHEN id % 4 = 2 THEN repeat('b', 64) ELSE concat(repeat('b', 64), id % 50) END AS t", "id % 9000 AS id")
    most, same = fullest(spark, mixed, by, ["t", "id"], 1000)
    assert same and most <= 4 * 1000


def test_small_cells_do_not_make_ever_more_tasks(spark, monkeypatch):
    """Each task sends sampled keys and a report to the driver; 2,000 cells of 10 rows were 2,000 tasks."""
    monkeypatch.setattr(assign, "MANY_TASKS", 12)
    rows, by = spark.range(20_000).selectExpr("id", "id % 7 AS k"), PartitionSpec("k", "modulo", 3, 8)
    path = fresh_path(spark, "dealt")
    cut = assign_segments(rows, by, ["id"], 10, staging=path)
    assert spark.read.parquet(path).select("__cell").distinct().count() <= 12
    assert cut.count() == 20_000 and cut.exceptAll(assign_segments(rows, by, ["id"], 10**9)).count() == 0


@pytest.mark.parametrize(
    "total, rows_per_cell, cells",
    [(10, 3, 4), (999_000, 1_000, 999), (54_000_000, 1_000, 1_000), (2 * 10**9, 1_000, 2_000), (2 * 10**9, 10**6, 2_000), (2 * 10**9, 10**7, 200)],
)
def test_cells_by_rows(total, rows_per_cell, cells):
    assert assign.cell_count(total, rows_per_cell) == cells


def test_folding_adds_no_shuffle(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    folded = assign_segments(orders, spec(12, 5, "hashcode", "o_orderkey"))
    assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()


def test_a_partition_that_goes_along_with_the_order_is_cut(spark):
    rows = spark.range(40_000).select("id", (F.col("id") / 1250).cast("int").alias("k"))
    assigned = assign_segments(rows, PartitionSpec("k", "modulo", 32, 64), ["id"], rows_per_cell=200)
    balance = segment_balance(assigned, PartitionSpec("k", "modulo", 32, 64)).collect()
    assert len(balance) == 32 and all(r.spread <= 1 for r in balance)


def test_dealing_does_not_depend_on_cells_or_files(spark, data):
    lines, by = spark.read.parquet(f"{data}/lineitem.parquet"), PartitionSpec("l_orderkey", "murmur", 4, 10)
    one = assign_segments(lines, by, ["l_returnflag"])
    other = assign_segments(lines.repartition(7), by, ["l_returnflag"], rows_per_cell=300)
    assert one.exceptAll(other).count() == 0 and one.count() == other.count()


def test_columns_named_like_helpers_are_kept(spark):
    rows = spark.range(300).selectExpr("id", "id as __rank", "id as __h_number", "id as `a.b`", "id as __tie")
    assigned = assign_segments(rows, PartitionSpec("id", "murmur", 2, 6), ["a.b"], rows_per_cell=40)
    assert assigned.columns == [*rows.columns, "pid", "segment_id"]
    assert assigned.where("id <> __rank or id <> __h_number or id <> `a.b` or id <> __tie").count() == 0
