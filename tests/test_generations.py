"""Generations of a table, rejected rows, time buckets and the job's new parts."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_sources import PARTITIONED, SCHEMA

from segloom.operators.assign import assign_segments
from segloom.operators.conform import bucket_number, event_time, part_rejects, time_bucket, with_reasons
from segloom.operators.generations import (
    changed_segments,
    commits,
    committed_manifest,
    expire_generations,
    scan_generation,
    segment_digests,
    write_generation,
)
from segloom.operators.manifest import require_reconciled, segment_manifest
from segloom.operators.sink import clean_target, write_segments
from segloom.plans.job import run_segment_job
from segloom.session import fresh_path
from segloom.sources.scan import scan
from segloom.sources.schema import PartitionSpec, load_layout, load_schema

SPEC = PartitionSpec("k", "modulo", 6, 6)


def rows(spark, n=600, salt=0):
    return spark.range(n).selectExpr("id", "id % 6 AS k", f"CASE WHEN id = 7 THEN 'v{salt}' ELSE concat('w', id) END AS v")


def run(spark, df, folder, **options):
    return write_generation(assign_segments(df, SPEC), folder, SPEC, "t", "1", **options)


def content(spark, folder, schema, commit=None):
    return sorted(tuple(r) for r in scan_generation(spark, folder, schema, commit).drop("segment_id").collect())


def test_only_changed_segments_are_written(spark):
    folder, schema = fresh_path(spark, "table"), rows(spark).schema
    assert content(spark, folder, schema) == [] and committed_manifest(spark, folder).count() == 0
    first = run(spark, rows(spark), folder)
    assert {r.segment_id for r in changed_segments(spark, folder).collect()} == set(range(6))
    again = run(spark, rows(spark).repartition(5).orderBy("v"), folder)
    assert changed_segments(spark, folder).count() == 0 and again.number == 2
    run(spark, rows(spark, salt=1), folder)
    assert [r.segment_id for r in changed_segments(spark, folder).collect()] == [1]
    assert content(spark, folder, schema) == sorted(tuple(r) for r in rows(spark, salt=1).collect())
    assert content(spark, folder, schema, first) == sorted(tuple(r) for r in rows(spark).collect())
    run(spark, rows(spark).where("k <> 2"), folder)
    assert content(spark, folder, schema) == sorted(tuple(r) for r in rows(spark).where("k <> 2").collect())
    gone = expire_generations(spark, folder, keep=1)
    assert len([g for g in gone if g.startswith("_commits")]) == 3
    assert content(spark, folder, schema) == sorted(tuple(r) for r in rows(spark).where("k <> 2").collect())
    run(spark, rows(spark, 0), folder)
    assert content(spark, folder, schema) == []


def test_a_run_that_ends_early_shows_nothing(spark):
    folder, schema = fresh_path(spark, "table"), rows(spark).schema
    run(spark, rows(spark, 60), folder)
    before = content(spark, folder, schema)
    # killed after its rows were written, before the manifest
    write_segments(assign_segments(rows(spark), SPEC), f"{folder}/_data/1-killed", SPEC)
    assert content(spark, folder, schema) == before
    # killed while the commit was written
    with open(f"{folder.removeprefix('file://').removeprefix('file:')}/_commits/0000000002.json", "w") as file:
        file.write('{"gener')
    assert content(spark, folder, schema) == before and len(commits(spark, folder)) == 1

    def refuse(manifest):
        assert manifest.agg(F.sum("record_count")).first()[0] == 600
        raise RuntimeError("not wanted")

    with pytest.raises(RuntimeError, match="not wanted"):
        run(spark, rows(spark), folder, accept=refuse)
    with pytest.raises(RuntimeError, match="committed number 2 first"):
        run(spark, rows(spark), folder)
    assert content(spark, folder, schema) == before
    assert "_data/1-killed" in expire_generations(spark, folder)
    assert content(spark, folder, schema) == before
    run(spark, rows(spark), folder)
    assert len(content(spark, folder, schema)) == 600


def test_digests_see_content_not_order(spark):
    df = spark.createDataFrame([(0, 1, "a", {"x": 1}), (0, 1, "a", {"x": 1}), (0, 2, None, {}), (1, 3, "b", None)], "segment_id int, n int, t string, m map<string,int>")
    base = {r.segment_id: r.digest for r in segment_digests(df).collect()}
    assert {r.segment_id: r.digest for r in segment_digests(df.orderBy("n").select("segment_id", "m", "t", "n")).collect()} == base
    fewer = {r.segment_id: r.digest for r in segment_digests(df.dropDuplicates(["n"])).collect()}
    assert fewer[0] != base[0] and fewer[1] == base[1]
    assert {r.segment_id: r.digest for r in segment_digests(df.withColumnRenamed("n", "o")).collect()}[1] != base[1]
    swapped = spark.createDataFrame([(1, "b", "3")], "segment_id int, n string, t string")
    assert segment_digests(swapped).first().digest != segment_digests(swapped.select("segment_id", F.col("t").alias("n"), F.col("n").alias("t"))).first().digest


SCHEMA_OF_TWO = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DecimalType(8, 2)), T.StructField("missing", T.DateType())])


def test_rejected_rows_with_reasons_and_places(spark):
    path = fresh_path(spark, "in")
    source = spark.createDataFrame([("1", "2.50", "x"), ("one", "1e9", "y"), (None, None, "z"), ("3", "cheap", "w")], "id string, price string, note string")
    source.coalesce(1).write.parquet(path)
    good, bad = part_rejects(scan(spark, path, "parquet"), SCHEMA_OF_TWO, fresh_path(spark, "out"), keep=["note"])
    assert good.columns == ["id", "price", "missing", "note"]
    assert sorted(r.note for r in good.collect()) == ["x", "z"]
    found = {r.note: r for r in bad.collect()}
    assert [tuple(x) for x in found["y"].reasons] == [("id", "one", "bigint"), ("price", "1e9", "decimal(8,2)")]
    assert [tuple(x) for x in found["w"].reasons] == [("price", "cheap", "decimal(8,2)")]
    assert found["w"].source_row == 3 and found["w"].source_file.endswith(".parquet") and found["w"].id == 3
    plain = with_reasons(source, SCHEMA_OF_TWO).collect()
    assert [len(r.reasons) for r in plain] == [0, 2, 0, 1] and plain[0].source_row is None
    with pytest.raises(ValueError):
        with_reasons(source.withColumnRenamed("note", "Reasons"), SCHEMA_OF_TWO, keep=["Reasons"])
    good, bad = part_rejects(source.limit(0), SCHEMA_OF_TWO, fresh_path(spark, "none"))
    assert (good.count(), bad.count()) == (0, 0)


@pytest.mark.parametrize(
    "kind, fmt, granularity, value, bucket, number",
    [
        (T.LongType(), "1:MILLISECONDS:EPOCH", "1:DAYS", 86_400_000 * 3 + 5, "1970-01-04 00:00:00", 3),
        (T.LongType(), "1:SECONDS:EPOCH", "15:MINUTES", -1, "1969-12-31 23:45:00", -1),
        (T.StringType(), "1:DAYS:SIMPLE_DATE_FORMAT:yyyy-MM-dd HH:mm", "6:HOURS", "2024-05-06 17:59", "2024-05-06 12:00:00", 79_398),
        (T.IntegerType(), "1:DAYS:SIMPLE_DATE_FORMAT:yyyyMMdd", "1:DAYS", 20240506, "2024-05-06 00:00:00", 19_849),
    ],
)
def test_time_buckets(spark, kind, fmt, granularity, value, bucket, number):
    field = T.StructField("the ts", kind, True, {"format": fmt, "granularity": granularity})
    df = spark.createDataFrame([(value,), (None,)], T.StructType([field]))
    out = df.select(time_bucket(field).cast("string"), bucket_number(field)).collect()
    assert [tuple(r) for r in out] == [(bucket, number), (None, None)]
    with pytest.raises(ValueError):
        time_bucket(T.StructField("x", kind, True, {"format": fmt, "granularity": "0:DAYS"}))
    with pytest.raises(ValueError):
        event_time(T.StructField("x", kind, True, {"format": "1:FORTNIGHTS:EPOCH"}))


def job(spark, base, where="true", **options):
    query = f"SELECT concat('ship-', id % 50) AS vessel, cast(id % 7 AS string) AS port, id AS cargo, id * 3600 AS sailed FROM range(500) WHERE {where}"
    return run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "7", base, **options)


def test_job_as_generations(spark):
    base = fresh_path(spark, "job")
    first = job(spark, base, generations=True)
    second = job(spark, base, generations=True)
    assert (first.commit.number, second.commit.number) == (1, 2)
    assert sorted(map(tuple, first.manifest.collect())) == sorted(map(tuple, second.manifest.collect()))
    assert changed_segments(spark, second.target).count() == 0
    third = job(spark, base, "id < 400", generations=True)
    assert third.manifest.agg(F.sum("record_count")).first()[0] == third.input_record_count == 400
    with pytest.raises(ValueError):
        job(spark, base, generations=True, template="${nonsense}")
    assert scan_generation(spark, third.target, load_schema(SCHEMA)).count() == 400
    with pytest.raises(ValueError):
        job(spark, None, generations=True)


def test_job_returns_statistics_zones_and_reads_a_template(spark):
    base, path = fresh_path(spark, "job"), fresh_path(spark, "template")
    for k, text in enumerate(("rows=${outputRecordCount}", "${nonsense}")):
        spark.createDataFrame([(text,)], "t string").coalesce(1).write.text(f"{path}{k}")
    with pytest.raises(ValueError, match="unknown template variables"):
        job(spark, base, template_path=f"{path}1")
    done = job(spark, base, template_path=f"{path}0", index=["vessel", "sailed"])
    used = done.manifest.where("record_count > 0").count()
    assert done.statistics.count() == used * len(load_schema(SCHEMA).fields)
    assert done.zones.count() == used
    assert job(spark, base, "false", index=["vessel", "sailed"]).zones is None
    with pytest.raises(ValueError):
        job(spark, base, template="x", template_path=path)


def test_observed_counts_are_held_against_what_was_written(spark):
    folder = fresh_path(spark, "seg")
    assigned = assign_segments(rows(spark), SPEC)
    write_segments(assigned, folder, SPEC)
    manifest = segment_manifest(spark, folder, "t", "1", 6)
    assert require_reconciled(spark.range(3), manifest, 600) == (600, 600)  # the source is not asked
    assert require_reconciled(spark.range(600), manifest, 1200) == (600, 600)  # counted twice by a repeated task
    clean_target(spark, f"{folder}/segment_id=2")
    with pytest.raises(RuntimeError, match="wrote 500"):
        require_reconciled(spark.range(600), segment_manifest(spark, folder, "t", "1", 6), 600)
