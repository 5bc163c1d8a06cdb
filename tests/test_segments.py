"""Writing, manifest, checks and pruned reads."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F
from test_sources import PARTITIONED, PLAIN, SCHEMA

from segloom.operators.assign import assign_segments
from segloom.operators.manifest import (
    emit_empty_segments,
    generation_summary,
    reconcile,
    require_reconciled,
    segment_column_stats,
    segment_manifest,
    segment_record_count,
)
from segloom.operators.prune import candidate_segments, prune_segments, scan_segments
from segloom.operators.sink import clean_target, gather_segments, route, target_folder, write_segments
from segloom.plans.job import run_segment_job
from segloom.session import fresh_path
from segloom.sources.scan import scan
from segloom.sources.schema import PartitionSpec, load_layout, load_schema

SPEC = PartitionSpec("k", "murmur", 4, 4)


def rows(spark, n=1000):
    return spark.range(n).select("id", F.concat(F.lit("key-"), F.col("id")).alias("k"))


def test_manifest_counts_sizes_and_empty_segments(spark):
    path = write_segments(assign_segments(rows(spark), SPEC).where("segment_id <> 2"), fresh_path(spark, "m"), SPEC)
    manifest = {r.segment_id: r for r in segment_manifest(spark, path, "t_OFFLINE", "77", 4).collect()}
    assert sorted(manifest) == [0, 1, 2, 3]
    assert manifest[0].segment_name == "t_OFFLINE_77_0"
    assert manifest[1].segment_uri == f"{path}/segment_id=1"
    assert (manifest[2].record_count, manifest[2].byte_size, manifest[2].file_count) == (0, 0, 0)
    assert all(manifest[i].byte_size > 0 for i in (0, 1, 3))


def test_manifest_of_an_empty_run(spark):
    path = write_segments(assign_segments(rows(spark, 0), SPEC), fresh_path(spark, "m"), SPEC)
    manifest = segment_manifest(spark, path, "t", "1", 3).collect()
    assert [r.record_count for r in manifest] == [0, 0, 0]


def test_manifest_reads_footers_only(spark):
    path = write_segments(assign_segments(rows(spark), SPEC), fresh_path(spark, "m"), SPEC)
    plan = segment_record_count(scan_segments(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_rerun_replaces_every_segment(spark):
    path, assigned = fresh_path(spark, "rerun"), assign_segments(rows(spark), SPEC)
    write_segments(assigned, path, SPEC)
    write_segments(assigned.where("segment_id = 1"), path, SPEC)
    assert {r.segment_id for r in scan_segments(spark, path).select("segment_id").distinct().collect()} == {1}


def test_a_hot_segment_is_cut_into_several_files(spark):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    wide = spark.range(0, 40000, 1, 16).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("filler"))
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        path = write_segments(assign_segments(wide, SPEC), fresh_path(spark, "hot"), SPEC)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = {r.segment_id: r.file_count for r in segment_manifest(spark, path, "t", "1", 4).collect()}
    assert max(files.values()) > 3
    assert scan_segments(spark, path).count() == 40000


def test_unpartitioned_rows_are_not_shuffled(spark):
    spec = PartitionSpec(None, None, 1, 3)
    gathered = gather_segments(assign_segments(rows(spark), spec), spec)
    assert "Exchange" not in gathered._jdf.queryExecution().executedPlan().toString()


def test_row_groups_and_codec(spark):
    import pyarrow.parquet as pq

    path = write_segments(assign_segments(rows(spark), SPEC), fresh_path(spark, "codec"), SPEC)
    local = path.removeprefix("file:")
    folder = next(e.path for e in os.scandir(local) if e.is_dir())
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    assert pq.ParquetFile(f"{folder}/{name}").metadata.row_group(0).column(0).compression == "SNAPPY"


def test_json_route_has_one_object_per_row_with_nulls(spark):
    source = spark.createDataFrame([("a\nb", None)], "k string, v array<int>")
    path = route(assign_segments(source, SPEC), fresh_path(spark, "json"), "json", SPEC)
    assert [json.loads(r.value) for r in spark.read.text(path).select("value").collect()] == [{"k": "a\nb", "v": None}]


@pytest.mark.parametrize("base, start", [("s3a://b/d", "s3a://b/d/"), ("s3a://b/d/", "s3a://b/d/"), (None, "file:///tmp/"), ("  ", "file:///tmp/")])
def test_target_folder(base, start):
    folder = target_folder(base, "t_OFFLINE", "20260427")
    assert folder.startswith(start)
    assert re.search(r"[^/]/t_OFFLINE/segments_20260427-[0-9a-f]{8}$", folder)
    assert folder != target_folder(base, "t_OFFLINE", "20260427")


def test_cleaning(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x").write_text("1")
    (tmp_path / "a" / "y").write_text("1")
    (tmp_path / "z").write_text("1")
    clean_target(spark, str(tmp_path / "none"))
    clean_target(spark, str(tmp_path / "a"))
    assert os.listdir(tmp_path / "a") == [] and (tmp_path / "z").exists()
    (tmp_path / "a" / "y").write_text("1")
    clean_target(spark, str(tmp_path / "z"))
    assert sorted(os.listdir(tmp_path)) == ["a"]
    assert (tmp_path / "a" / "y").exists()
    with pytest.raises(ValueError, match="root"):
        clean_target(spark, "file:///")


def test_reconciling(spark):
    counts = segment_record_count(assign_segments(rows(spark), SPEC))
    assert require_reconciled(rows(spark), counts) == (1000, 1000)
    short = counts.where("segment_id <> 0")
    assert reconcile(rows(spark), short).first().matched is False
    with pytest.raises(RuntimeError, match="read 1000 rows but wrote"):
        require_reconciled(rows(spark), short)
    assert require_reconciled(rows(spark, 0), counts.where("false")) == (0, 0)


def test_summary(spark):
    path = write_segments(assign_segments(rows(spark), SPEC), fresh_path(spark, "m"), SPEC)
    summary = generation_summary(segment_manifest(spark, path, "t", "1", 6), rows(spark), path).first()
    assert (summary.segment_count, summary.record_count, summary.input_record_count) == (6, 1000, 1000)
    assert summary.byte_size > 0 and summary.input_byte_size >= summary.byte_size


def test_empty_counts_become_zero(spark):
    counts = spark.createDataFrame([(2, 5)], "segment_id int, record_count long")
    assert [tuple(r) for r in emit_empty_segments(counts, 3).orderBy("segment_id").collect()] == [(0, 0), (1, 0), (2, 5)]


def test_column_stats_of_nested_and_null_columns(spark):
    source = spark.createDataFrame([([1, 2], {"a": 1}, None, 0), ([1], {"a": 1}, None, 0)], "l array<int>, m map<string,int>, n string, segment_id int")
    exact = {r.column_name: r for r in segment_column_stats(source, exact=True).collect()}
    assert (exact["l"].min_value, exact["l"].max_value, exact["l"].distinct_count) == ("[1]", "[1,2]", 2)
    assert exact["m"].distinct_count == 1
    assert (exact["n"].null_count, exact["n"].distinct_count, exact["n"].min_value) == (2, 0, None)
    assert {r.column_name: r.distinct_count for r in segment_column_stats(source).collect()} == {"l": 2, "m": 1, "n": 0}


@pytest.mark.parametrize("function, p, s", [("murmur", 8, 32), ("murmur", 8, 3), ("hashcode", 4, 4), ("hashcode", 3, 8)])
def test_pruning_finds_all_rows_of_a_key_in_few_segments(spark, function, p, s):
    spec = PartitionSpec("k", function, p, s)
    source = spark.range(4000).select("id", (F.col("id") % 40).cast("string").alias("k"))
    path = write_segments(assign_segments(source, spec, ["id"]), fresh_path(spark, "prune"), spec)
    found = prune_segments(scan_segments(spark, path), spec, ["7", "no such key"])
    assert found.count() == 100
    candidates = len(candidate_segments(spark, spec, ["7"]))
    assert candidates in ({1} if s <= p else {s // p, -(-s // p)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*segment_id", plan)
    assert re.search(r"PushedFilters: \[.*k", plan)


def test_pruning_to_null_and_numbers(spark):
    spec = PartitionSpec("k", "hashcode", 4, 8)
    source = spark.range(100).select("id", F.when(F.col("id") > 9, F.col("id") % 5).alias("k"))
    path = write_segments(assign_segments(source, spec, ["id"]), fresh_path(spark, "prune"), spec)
    stored = scan_segments(spark, path)
    assert prune_segments(stored, spec, [None]).count() == 10
    assert prune_segments(stored, spec, [3, None]).count() == 28
    assert prune_segments(stored, spec, []).count() == 0
    with pytest.raises(ValueError, match="no partition column"):
        prune_segments(stored, PartitionSpec(None, None, 1, 2), [1])
    assert candidate_segments(spark, PartitionSpec(None, None, 1, 2), [1]) == [0]


def small_table(spark, values, name="rows_to_load"):
    spark.createDataFrame(values, "vessel string, port string, cargo long, sailed long").createOrReplaceTempView(name)
    return f"SELECT * FROM {name}"


SET_A = [("Ada", "Turku", 31, 946_684_800), ("Dora", "Riga", 58, 946_771_200)]
SET_B = [(vessel, f"port {i}", 7 * i, 946_684_800 + i) for i, vessel in enumerate(("Ada", "Dora", "Elsa", "Juno"))]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_job_without_partitioning(spark, fmt):
    query = small_table(spark, SET_A)
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PLAIN)), "spring", fresh_path(spark, "job"), fmt)
    manifest = job.manifest.collect()
    assert [(r.segment_name, r.record_count) for r in manifest] == [("voyages_OFFLINE_spring_0", 2)]
    assert job.input_record_count == 2 and job.summary.first().input_byte_size > 0
    assert sorted(tuple(r)[:4] for r in scan_segments(spark, job.target).collect()) == SET_A


def test_job_with_repeated_input(spark):
    query = small_table(spark, SET_A) + " UNION ALL SELECT * FROM rows_to_load"
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PLAIN)), "1", fresh_path(spark, "job"))
    assert [r.record_count for r in job.manifest.collect()] == [4]


def test_job_with_two_partitions(spark):
    query = small_table(spark, SET_B)
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"), "json")
    counts = [r.record_count for r in job.manifest.orderBy("segment_id").collect()]
    assert len(counts) == 2 and sum(counts) == 4


def test_job_with_all_rows_in_one_partition(spark):
    query = small_table(spark, [SET_A[0], SET_A[0]])
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"))
    assert sorted(r.record_count for r in job.manifest.collect()) == [0, 2]


def test_job_deals_rows_in_file_order(spark):
    query = small_table(spark, SET_B * 25)
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"), segment_count=6)
    counts = [r.record_count for r in job.manifest.orderBy("segment_id").collect()]
    assert sum(counts) == 100
    assert max(counts[:3]) - min(counts[:3]) <= 1 and max(counts[3:]) - min(counts[3:]) <= 1
    assert scan_segments(spark, job.target).columns == ["vessel", "port", "cargo", "sailed", "segment_id"]


def test_job_on_json_deals_by_content(spark):
    query = small_table(spark, SET_B * 25)
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"), "json", segment_count=6)
    counts = [r.record_count for r in job.manifest.orderBy("segment_id").collect()]
    assert sum(counts) == 100 and max(counts[:3]) - min(counts[:3]) <= 1 and max(counts[3:]) - min(counts[3:]) <= 1


def test_staged_rows_go_whatever_the_outcome(spark, tmp_path):
    query, staging = small_table(spark, SET_B), f"file:{tmp_path}/staging"
    layout = load_layout(json.dumps(PARTITIONED))
    run_segment_job(spark, query, load_schema(SCHEMA), layout, "1", f"file:{tmp_path}/job", segment_count=6, staging=staging)
    assert list((tmp_path / "staging").iterdir()) == []
    with pytest.raises(Exception, match="no such column"):
        run_segment_job(spark, query, load_schema(SCHEMA), layout, "1", f"file:{tmp_path}/bad", segment_count=6, staging=staging, order_by=["no such column"])
    assert list((tmp_path / "staging").iterdir()) == []
    assert not (tmp_path / "bad").exists() or not [p for p in (tmp_path / "bad").rglob("*.parquet")]


def test_pruning_refuses_values_the_key_cannot_hold(spark):
    spec = PartitionSpec("k", "modulo", 4, 4)
    path = write_segments(assign_segments(spark.range(40).withColumnRenamed("id", "k"), spec), fresh_path(spark, "prune"), spec)
    stored = scan_segments(spark, path)
    assert prune_segments(stored, spec, [1.0, 7]).count() == 2
    with pytest.raises(ValueError, match="bigint"):
        prune_segments(stored, spec, [1.5])


def test_job_routes_on_a_column_outside_the_schema(spark):
    spark.createDataFrame([(i, str(i)) for i in range(50)], "cargo long, vessel string").createOrReplaceTempView("outside")
    schema = load_schema(json.dumps({"metricFieldSpecs": [{"name": "cargo", "dataType": "LONG"}]}))
    job = run_segment_job(spark, "SELECT * FROM outside", schema, load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"), "json")
    assert all(r.record_count > 0 for r in job.manifest.collect())
    assert scan_segments(spark, job.target).columns == ["cargo", "segment_id"]


def test_job_plan_for_a_local_target(spark):
    query = small_table(spark, SET_B)
    job = run_segment_job(spark, query, load_schema(SCHEMA), load_layout(json.dumps(PARTITIONED)), "1", fresh_path(spark, "job"), push_delay_seconds=7)
    plan = job.plan.orderBy("push_order").collect()
    assert [(r.push_order, r.upload_mode, r.push_offset_seconds, r.payload) for r in plan] == [(1, "FILE", 0, None), (2, "FILE", 7, None)]
    assert {(r.base_table_name, r.table_type) for r in plan} == {("voyages", "OFFLINE")}


@pytest.mark.parametrize("keep, left", [(False, 0), (True, 2)])
def test_job_removes_its_staging(spark, keep, left):
    staging = fresh_path(spark, "staging")
    job = run_segment_job(
        spark, small_table(spark, SET_A), load_schema(SCHEMA), load_layout(json.dumps(PLAIN)), "1", fresh_path(spark, "job"),
        staging=staging, keep_staging=keep,
    )
    assert scan(spark, staging, "parquet", load_schema(SCHEMA)).count() == left
    assert job.plan.count() == job.manifest.count() == 1
    assert job.summary.first().input_record_count == 2


def test_failed_job_leaves_no_segments(spark):
    base = fresh_path(spark, "job")
    spark.createDataFrame([("a", "x"), ("b", "12")], "vessel string, cargo string").createOrReplaceTempView("bad_values")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_segment_job(spark, "SELECT * FROM bad_values", load_schema(SCHEMA), load_layout(json.dumps(PLAIN)), "1", base)
    assert scan(spark, base, "parquet", load_schema(SCHEMA)).count() == 0


def test_taken_column_names_are_refused(spark):
    with pytest.raises(ValueError, match="already have"):
        assign_segments(rows(spark).withColumn("PID", F.lit(1)), SPEC)
    with pytest.raises(ValueError, match="already have"):
        assign_segments(rows(spark).withColumn("segment_id", F.lit(1)), SPEC)
