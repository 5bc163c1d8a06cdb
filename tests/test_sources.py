import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.operators.conform import conform, conform_types, event_time, project_physical
from segloom.session import fresh_path, materialise, shared_root
from segloom.sources.extract import extract, stage
from segloom.sources.formats import (
    check_storage,
    has_avro,
    stageable_format,
    storage_scheme,
    writable_format,
)
from segloom.sources.scan import input_file_stats, input_files, scan, scan_many, with_row_position
from segloom.sources.schema import PartitionSpec, load_layout, load_schema, partition_spec

SCHEMA = json.dumps(
    {
        "schemaName": "voyages",
        "dimensionFieldSpecs": [{"name": "vessel", "dataType": "STRING"}, {"name": "port", "dataType": "STRING"}],
        "metricFieldSpecs": [{"name": "cargo", "dataType": "LONG"}],
        "dateTimeFieldSpecs": [
            {"name": "sailed", "dataType": "LONG", "format": "1:SECONDS:EPOCH", "granularity": "6:HOURS"}
        ],
    }
)
PLAIN = {"tableName": "voyages_OFFLINE", "segmentsConfig": {"timeColumnName": "sailed"}, "tableIndexConfig": {"nullHandlingEnabled": True}}
PARTITIONED = PLAIN | {
    "tableIndexConfig": {
        "segmentPartitionConfig": {"columnPartitionMap": {"vessel": {"functionName": "Murmur", "numPartitions": 2}}}
    }
}


def test_schema_roles_types_and_time_format():
    schema = load_schema(SCHEMA)
    assert schema.names == ["vessel", "port", "cargo", "sailed"]
    assert [f.metadata["role"] for f in schema] == ["dimension", "dimension", "metric", "dateTime"]
    assert schema["cargo"].dataType == T.LongType()
    assert schema["sailed"].metadata["format"] == "1:SECONDS:EPOCH"


def test_schema_multi_value_and_bad_types():
    field = {"name": "tags", "dataType": "STRING", "singleValueField": False}
    assert load_schema(json.dumps({"dimensionFieldSpecs": [field]}))["tags"].dataType == T.ArrayType(T.StringType())
    with pytest.raises(ValueError, match="unknown data type"):
        load_schema(json.dumps({"metricFieldSpecs": [{"name": "x", "dataType": "COMPLEX"}]}))
    with pytest.raises(ValueError, match="twice"):
        load_schema(json.dumps({"dimensionFieldSpecs": [field, field]}))


@pytest.mark.parametrize(
    "document",
    [
        PARTITIONED,
        {"tableName": "voyages", "offline": PARTITIONED, "realtime": None},
        {"tableName": "voyages", "offline": None, "realtime": PARTITIONED},
        {"offline": PARTITIONED, "realtime": PLAIN},
    ],
)
def test_layout(document):
    layout = load_layout(json.dumps(document))
    assert (layout.table_name, layout.time_column) == ("voyages_OFFLINE", "sailed")
    assert (layout.partition_column, layout.partition_function, layout.partition_count) == ("vessel", "Murmur", 2)


def test_layout_without_partitioning_and_with_too_much():
    assert partition_spec(load_layout(json.dumps(PLAIN))) == PartitionSpec(None, None, 1, 1)
    entry = {"functionName": "Murmur", "numPartitions": 2}
    many = {"segmentPartitionConfig": {"columnPartitionMap": {"a": entry, "b": entry}}}
    with pytest.raises(ValueError, match="only one"):
        load_layout(json.dumps(PLAIN | {"tableIndexConfig": many}))


@pytest.mark.parametrize("wanted, segments, spreads", [(0, 2, False), (1, 1, False), (5, 5, True)])
def test_partition_spec(wanted, segments, spreads):
    spec = partition_spec(load_layout(json.dumps(PARTITIONED)), wanted)
    assert (spec.column, spec.partition_count, spec.segment_count, spec.spreads) == ("vessel", 2, segments, spreads)


def test_partition_spec_limits():
    with pytest.raises(ValueError, match="at least 1"):
        partition_spec(load_layout(json.dumps(PARTITIONED)), -1)
    assert PartitionSpec("k", None, 0, 0) == PartitionSpec("k", None, 1, 1)


@pytest.mark.parametrize("query", [None, "", "  \n"])
def test_blank_query(spark, query):
    with pytest.raises(ValueError, match="query"):
        extract(spark, query)


@pytest.mark.parametrize("destination, fmt", [("", "json"), (" ", "json"), ("/tmp/x", ""), ("/tmp/x", None), ("/tmp/x", "csv")])
def test_bad_stage_arguments(spark, destination, fmt):
    with pytest.raises(ValueError):
        stage(spark.range(1), destination, fmt)


def avro_file(spark, path, rows):
    """Written by the Avro library itself, in the driver's JVM."""
    jvm = spark._jvm
    fields = [{"name": "id", "type": ["null", "string"]}, {"name": "value", "type": "long"}, {"name": "tags", "type": {"type": "array", "items": "int"}}]
    schema = jvm.org.apache.avro.Schema.Parser().parse(json.dumps({"type": "record", "name": "row", "fields": fields}))
    writer = jvm.org.apache.avro.file.DataFileWriter(jvm.org.apache.avro.generic.GenericDatumWriter(schema))
    writer.create(schema, jvm.java.io.File(str(path)))
    for identifier, value, tags in rows:
        record = jvm.org.apache.avro.generic.GenericData.Record(schema)
        items = jvm.java.util.ArrayList()
        for tag in tags:
            items.add(tag)
        record.put("id", identifier)
        record.put("value", jvm.java.lang.Long.valueOf(value))
        record.put("tags", items)
        writer.append(record)
    writer.close()


def test_avro_scan(spark, tmp_path):
    (tmp_path / "below").mkdir()
    avro_file(spark, tmp_path / "a.avro", [(AWKWARD, 2**62, [1, 2]), (None, -1, [])])
    avro_file(spark, tmp_path / "below" / "b.avro", [("z", 3, [7])])
    schema = T._parse_datatype_string("id string, value long, tags array<int>, missing double")
    top = [(AWKWARD, 2**62, [1, 2], None), (None, -1, [], None)]
    assert [tuple(r) for r in scan(spark, str(tmp_path), "Avro", schema, recursive=False).collect()] == top
    everything = {tuple(map(str, r)) for r in scan(spark, str(tmp_path), "avro", schema).collect()}
    assert everything == {tuple(map(str, r)) for r in [*top, ("z", 3, [7], None)]}
    assert scan(spark, str(tmp_path / "none"), "avro", schema).count() == 0


def test_avro_limits(spark):
    with pytest.raises(NotImplementedError):
        stageable_format("AVRO")
    if not has_avro(spark):
        with pytest.raises(NotImplementedError, match="spark-avro"):
            writable_format(spark, "avro")
        with pytest.raises(ValueError, match="schema"):
            scan(spark, "/tmp", "avro")
        # as text these would come without their logical type
        for kind in (T.BinaryType(), T.TimestampType(), T.DateType(), T.DecimalType(9, 2)):
            with pytest.raises(NotImplementedError, match="needs the spark-avro module"):
                scan(spark, "/tmp", "avro", T.StructType().add("b", kind))


def test_schemes(spark):
    assert storage_scheme("/a/b") == storage_scheme("file:///a") == "file"
    assert check_storage(spark, "/a/b") == "file"
    with pytest.raises(ValueError, match="no file system"):
        check_storage(spark, "nosuch://bucket/a")
    with pytest.raises(ValueError, match="no file system"):
        stage(spark.range(1), "nosuch://bucket/a", "json")


AWKWARD = 'back\\slash "quoted"\nnew line\ttab \u0001 é😀'


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_round_trip_keeps_awkward_values(spark, fmt):
    source = spark.createDataFrame([(AWKWARD, None, [1, None], {"a": 1.5}), (None, 2, [], {})], "s string, n long, l array<long>, m map<string,double>")
    source = source.withColumn("t", F.lit("2024-02-03 04:05:06.789012").cast("timestamp_ntz"))
    back = scan(spark, stage(source, fresh_path(spark, "awkward"), fmt), fmt, source.schema)
    assert sorted(back.collect(), key=str) == sorted(source.collect(), key=str)


def test_json_staging_writes_explicit_nulls(spark):
    path = stage(spark.createDataFrame([Row(a=None, b=1)], "a string, b int"), fresh_path(spark, "nulls"), "json")
    assert spark.read.text(path).first()[0] == '{"a":null,"b":1}'


def test_bad_json_fails_the_scan(spark):
    path = fresh_path(spark, "bad")
    spark.createDataFrame([("{not json",)], "value string").write.text(path)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan(spark, path, "json", T.StructType().add("a", T.IntegerType())).collect()


def test_scan_of_nothing(spark):
    missing = fresh_path(spark, "missing")
    schema = T.StructType().add("a", T.IntegerType())
    for fmt in ("json", "parquet"):
        assert scan(spark, missing, fmt, schema).count() == 0
    with pytest.raises(ValueError, match="nothing to read"):
        scan(spark, missing, "parquet")
    with pytest.raises(ValueError, match="schema"):
        scan(spark, missing, "json")


def test_folder_levels(spark):
    root = fresh_path(spark, "levels")
    stage(spark.range(3), root, "parquet")
    stage(spark.range(5), f"{root}/below/deeper", "parquet")
    stage(spark.range(7), f"{root}/x=1", "parquet")
    direct = scan(spark, root, "parquet", recursive=False)
    assert direct.columns == ["id"] and direct.count() == 3
    assert scan(spark, root, "parquet", recursive=True).count() == 15
    below = fresh_path(spark, "levels")
    stage(spark.range(7), f"{below}/x=1", "parquet")
    assert scan(spark, below, "parquet", spark.range(0).schema, recursive=False).count() == 0


def test_concat_fills_missing_columns(spark):
    both = scan_many([spark.range(2).select("id"), spark.range(1).withColumn("x", F.lit("y"))])
    assert sorted((r.id, r.x) for r in both.collect() if r.x is None) == [(0, None), (1, None)]
    with pytest.raises(ValueError):
        scan_many([])


def test_file_stats_do_not_read_contents(spark, data):
    plan = input_files(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan
    path = fresh_path(spark, "empty")
    spark.range(0).write.parquet(path)
    assert input_file_stats(spark, path).first().byte_size > 0


def test_row_position_is_unique(spark, data):
    rows = with_row_position(spark.read.parquet(f"{data}/orders.parquet"))
    assert rows.select("__row_file", "__row_index").distinct().count() == rows.count()


def test_parquet_scan_prunes_columns_and_pushes_filters(spark, data):
    rows = scan(spark, f"{data}/orders.parquet", "parquet").where("o_orderkey > 10").select("o_custkey")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_projection_adds_nulls_and_drops_extras(spark):
    schema = load_schema(SCHEMA)
    rows = project_physical(spark.createDataFrame([("a", 1, True)], "Vessel string, cargo long, extra boolean"), schema, keep=["extra"])
    assert rows.columns == ["vessel", "port", "cargo", "sailed", "extra"]
    assert rows.first().port is None and rows.first().vessel == "a"


def test_conforming_casts_strictly_or_not(spark):
    schema = load_schema(SCHEMA)
    rows = spark.createDataFrame([("a", "b", "12", "x")], "vessel string, port string, cargo string, sailed string")
    assert conform_types(rows, schema, strict=False).first() == Row(vessel="a", port="b", cargo=12, sailed=None)
    assert conform(rows.drop("sailed"), schema).schema["sailed"].metadata["role"] == "dateTime"
    with pytest.raises(PySparkException):
        conform_types(rows, schema).collect()


@pytest.mark.parametrize("fmt, value, expected", [("1:MILLISECONDS:EPOCH", 1700000000000, "2023-11-14 22:13:20"), ("1:DAYS:EPOCH", 19675, "2023-11-14 00:00:00"), ("5:MINUTES:EPOCH", 1, "1970-01-01 00:05:00")])
def test_event_time(spark, fmt, value, expected):
    field = T.StructField("ts", T.LongType(), True, {"format": fmt})
    text = event_time(field).cast("string")
    assert spark.createDataFrame([(value,)], "ts long").select(text).first()[0] == expected
    with pytest.raises(ValueError, match="epoch"):
        event_time(T.StructField("ts", T.LongType()))


def test_shared_storage(spark):
    root = shared_root(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")
    assert materialise(spark.range(3)).count() == 3
