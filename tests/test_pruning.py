"""Reads that skip segments: by a table of keys, by zone maps, by membership sketches; and mergeable sketches."""

import datetime
import itertools
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from segloom.operators.assign import assign_segments
from segloom.operators.members import member_segments, member_sketch, prune_by_members, write_members
from segloom.operators.prune import WANTED, candidate_segments, prune_by_keys, prune_segments, scan_segments, typed_keys
from segloom.operators.sink import write_segments
from segloom.operators.sketches import merge_sketches, segment_sketches, sketch_estimates
from segloom.operators.zones import Compare, Every, Missing, Not, Some, among, between, prune_by_zones, write_zones, zone_map, zone_segments
from segloom.session import fresh_path
from segloom.sources.schema import PartitionSpec


def written(spark, rows, spec, **options):
    return write_segments(assign_segments(rows, spec, **options), fresh_path(spark, "prune"), spec)


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def spoil(path, keep):
    """Makes the files of all other segments unreadable; returns how many were spoilt."""
    spoilt = 0
    for folder in os.listdir(local(path)):
        if folder.startswith("segment_id=") and int(folder.split("=")[1]) not in keep:
            for name in os.listdir(f"{local(path)}/{folder}"):
                if not name.startswith("."):
                    spoilt += 1
                    with open(f"{local(path)}/{folder}/{name}", "wb") as file:
                        file.write(b"spoilt")
    return spoilt


@pytest.mark.parametrize(
    "expression", ["date_add(date'2024-01-01', cast(id % 40 as int))", "cast(id % 40 as decimal(9,2)) / 4", "id % 40 = 3", "timestamp_millis(id % 40 * 1234567)"]
)
@pytest.mark.parametrize("function, segments", [("murmur", 4), ("hashcode", 13)])
def test_key_tables_and_literals_of_every_type(spark, expression, function, segments):
    spec = PartitionSpec("k", function, 7, segments)
    rows = spark.range(400).select("id", F.expr(f"CASE WHEN id % 50 = 49 THEN NULL ELSE {expression} END").alias("k"))
    path = written(spark, rows, spec, **({"order_by": ["id"]} if spec.spreads else {}))
    for pick in ("id = 3", "id in (3, 4, 49)", "id % 50 = 49", "id < 0", "id < 60"):
        keys = rows.where(pick).select("k")
        values = list({r.k for r in keys.collect()})
        want = sorted(r.id for r in rows.collect() if r.k in values)
        found = prune_by_keys(scan_segments(spark, path), spec, keys.unionAll(keys), "k")
        assert sorted(r.id for r in found.collect()) == want
        assert found.columns == ["id", "k", "segment_id"]
        assert sorted(r.id for r in prune_segments(scan_segments(spark, path), spec, values).collect()) == want


def test_key_table_reads_only_its_segments(spark):
    spec = PartitionSpec("k", "modulo", 8, 8)
    rows = spark.range(800).select("id", (F.col("id") % 80).alias("k"))
    path = written(spark, rows, spec)
    df = scan_segments(spark, path)
    keys = spark.createDataFrame([(3,), (11,), (4,), (None,), (3,)], "wanted bigint")
    ids = candidate_segments(spark, spec, [3, 11, 4], df.schema["k"].dataType)
    assert ids == [3, 4] and spoil(path, ids) >= 6
    found = prune_by_keys(df, spec, keys, "wanted")
    assert sorted(r.k for r in found.collect()) == [3] * 10 + [4] * 10 + [11] * 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_keys_that_the_type_cannot_hold_match_nothing(spark):
    keys = spark.createDataFrame([(Decimal("3.00"),), (Decimal("3.50"),), (None,), (Decimal("99999999999999.00"),)], "k decimal(20,2)")
    kind = spark.range(1).select(F.lit(1)).schema[0].dataType
    assert sorted((r[0] for r in typed_keys(keys, "k", kind).collect()), key=str) == [3, None]
    texts = spark.createDataFrame([("7",), ("x",)], "k string")
    assert [r[0] for r in typed_keys(texts, "k", kind).collect()] == [7]
    with pytest.raises(ValueError):
        prune_by_keys(spark.range(3), PartitionSpec(None, None, 1, 1), texts, "k")


def cases():
    parts = [
        Compare("a", "=", 40), Compare("a", "<", 7), Compare("a", ">=", 92), Compare("b", "=", "m"), Compare("b", ">", "x" * 70),
        Compare("b", "<=", "x" * 66), Missing("c"), Compare("c", "<", 0.5), Compare("c", "=", None), Compare("a", ">", 49.5), among("a", [1, 55]),
        between("d", datetime.date(2024, 1, 5), datetime.date(2024, 1, 7)),
    ]
    pairs = [op(x, y) for x, y in itertools.combinations(parts, 2) for op in (Every, Some)]
    random.Random(1).shuffle(pairs)
    chosen = parts + pairs[:24]
    return chosen + [Not(c) for c in chosen]


def zoned(spark):
    """Ten segments by ten values of ``a``; one has only nulls in ``c`` and one a value that is not a number."""
    return spark.range(200).selectExpr(
        "cast(id % 100 as int) AS a",
        "CASE WHEN id % 100 < 30 THEN repeat('x', 60 + cast(id % 30 as int)) WHEN id % 7 = 0 THEN NULL ELSE chr(cast(97 + id % 26 as int)) END AS b",
        "CASE WHEN id % 100 >= 90 THEN NULL WHEN id % 100 = 85 THEN double('NaN') ELSE (id % 100) / 50 END AS c",
        "date_add(date'2024-01-01', cast(id % 100 div 10 as int)) AS d",
        "cast(id % 100 div 10 as int) AS segment_id",
    )


def test_conditions_on_zones_never_lose_a_row(spark):
    df = zoned(spark).cache()
    zones = zone_map(df).cache()
    loose = 0
    for condition in cases():
        holding = {r.segment_id for r in df.where(condition.rows(df.schema)).select("segment_id").distinct().collect()}
        chosen = {r.segment_id for r in zone_segments(zones, condition, df.schema).collect()}
        assert holding <= chosen, condition
        loose += len(chosen - holding)
    single = {c: {r.segment_id for r in zone_segments(zones, c, df.schema).collect()} for c in cases()[:3]}
    assert list(single.values()) == [{4}, {0}, {9}]
    assert loose < 100  # of some 70 conditions on ten segments
    assert {r.segment_id for r in zone_segments(zones, Not(Missing("c")), df.schema).collect()} == set(range(9))


def test_zone_pruned_read_opens_no_other_file(spark):
    spec = PartitionSpec("band", "modulo", 16, 16)
    rows = spark.range(1600).select("id", F.expr("id div 100").alias("band"), (F.col("id") * 2).alias("v"))
    path = written(spark, rows, spec)
    zones = write_zones(spark, path, ["id", "v"])
    df = scan_segments(spark, path)
    assert spoil(path, [2, 3]) >= 14
    condition = between("id", 250, 320) & ~Compare("v", "=", 520)
    found = prune_by_zones(df, zones, condition, 16)
    assert sorted(r.id for r in found.collect()) == [k for k in range(250, 320) if k != 260]
    with pytest.raises(ValueError):
        zone_map(df.withColumn("m", F.create_map("id", "v")), ["m"])
    assert zone_map(df.limit(0)).count() == 0


def test_members_have_no_false_negative_and_few_false_positives(spark):
    rng = random.Random(5)
    rows = [(s, rng.randrange(10**6), rng.choice(["é", None, "", "b"]) if s % 3 else f"t{s}") for s in range(20) for _ in range(300)]
    df = spark.createDataFrame(rows, "segment_id int, n bigint, t string").cache()
    sketch = member_sketch(df, ["n", "t"]).cache()
    holders = {}
    for s, n, t in rows:
        holders.setdefault(("n", n), set()).add(s)
        holders.setdefault(("t", t), set()).add(s)
    wrong = asked = 0
    for column, values in (("n", [r[1] for r in rows[::40]] + [-k for k in range(1, 200)]), ("t", ["é", None, "", "b", "t3", "none"])):
        keys = spark.createDataFrame([(v,) for v in values], f"{WANTED} {'bigint' if column == 'n' else 'string'}")
        found = {}
        for r in member_segments(sketch, column, keys.distinct()).collect():
            found.setdefault(r[WANTED], set()).add(r.segment_id)
        for v in set(values):
            assert holders.get((column, v), set()) <= found.get(v, set())
            wrong += len(found.get(v, set()) - holders.get((column, v), set()))
            asked += 20
    assert wrong / asked < 0.02


def test_members_at_the_least_size_and_in_reads(spark):
    spec = PartitionSpec("k", "modulo", 10, 10)
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), F.concat(F.lit("name-"), (F.col("id") * 7919).cast("string")).alias("name"))
    path = written(spark, rows, spec)
    sketch = write_members(spark, path, ["name"])
    crowded = member_sketch(scan_segments(spark, path), ["name"], {"name": 64})
    keys = spark.createDataFrame([("name-15838",), ("name-nothing",), ("name-0",)], "n string")
    df = scan_segments(spark, path)
    for chosen in (sketch, crowded):
        assert sorted(r.name for r in prune_by_members(df, chosen, "name", keys, "n", 10).collect()) == ["name-0", "name-15838"]
    ids = {r.segment_id for r in member_segments(sketch, "name", typed_keys(keys, "n", df.schema["name"].dataType)).collect()}
    assert {0, 2} <= ids and len(ids) <= 4
    spoil(path, ids)
    assert prune_by_members(df, sketch, "name", keys, "n", 10).count() == 2


def test_merged_sketches_estimate_the_whole(spark):
    df = spark.range(60_000).selectExpr(
        "id", "id % 17000 AS many", "cast(id % 3 as string) AS few", "double(id) / 7 AS x", "cast(null as int) AS none",
        "timestamp_seconds(id) AS at", "array(id % 5) AS parts", "cast(id % 12 as int) AS segment_id",
    )
    first, second = segment_sketches(df.where("id < 20000")), segment_sketches(df.where("id >= 20000"))
    rows = {r.column_name: r for r in sketch_estimates(merge_sketches(first.unionByName(second)), [0.0, 0.5, 1.0]).collect()}
    for name, exact in {"id": 60_000, "many": 17_000, "few": 3, "x": 60_000, "none": 0, "at": 60_000, "parts": 5}.items():
        assert abs(rows[name].distinct_estimate - exact) <= 0.05 * exact
        assert (rows[name].record_count, rows[name].null_count) == (60_000, 60_000 if name == "none" else 0)
    for name, scale in (("id", 1), ("x", 1 / 7), ("at", 1)):
        low, middle, high = rows[name].quantiles
        assert (low, high) == (0, 59_999 * scale) and abs(middle - 30_000 * scale) < 0.03 * 60_000 * scale
    assert rows["few"].quantiles is None and rows["none"].quantiles is None
