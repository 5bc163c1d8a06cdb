"""One query per operator, each over whole tables of the given folder.

Operators that write do so in a fresh folder of shared storage and read it back.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.functions.hashing import partition_id
from segloom.functions.keys import partition_key
from segloom.operators.assign import assign_segments, segment_range, with_partition_id
from segloom.operators.conform import (
    bucket_number,
    conform_types,
    event_time,
    part_rejects,
    project_physical,
    time_bucket,
)
from segloom.operators.generations import changed_segments, scan_generation, write_generation
from segloom.operators.manifest import (
    emit_empty_segments,
    generation_summary,
    input_record_count,
    reconcile,
    segment_balance,
    segment_byte_size,
    segment_column_stats,
    segment_fill,
    segment_manifest,
    segment_purity,
    segment_record_count,
    segment_time_range,
)
from segloom.operators.members import prune_by_members, write_members
from segloom.operators.prune import prune_by_keys, prune_segments, scan_segments
from segloom.operators.publish import (
    publish_plan,
    publish_problems,
    with_input_totals,
    with_payload,
)
from segloom.operators.sink import (
    clean_target,
    route,
    segment_name,
    target_folder,
    write_segments,
)
from segloom.operators.sketches import merge_sketches, segment_sketches, sketch_estimates
from segloom.operators.zones import Compare, Condition, Missing, Not, between, prune_by_zones, write_zones, zone_segments
from segloom.plans.job import run_segment_job
from segloom.session import fresh_path, shared_root
from segloom.sources.extract import extract, stage
from segloom.sources.scan import input_file_stats, scan, scan_many
from segloom.sources.schema import PartitionSpec, load_layout, load_schema, partition_spec

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

KEY = "20240131"
TABLE = "orders_OFFLINE"
# Small enough that the test tables are cut into many cells.
CELL = 1_000

ORDERS_SCHEMA = json.dumps(
    {
        "schemaName": "orders",
        "dimensionFieldSpecs": [
            {"name": "o_orderkey", "dataType": "LONG"},
            {"name": "o_custkey", "dataType": "LONG"},
            {"name": "o_orderstatus", "dataType": "STRING"},
            {"name": "o_orderpriority", "dataType": "STRING"},
        ],
        "metricFieldSpecs": [{"name": "o_totalprice", "dataType": "DOUBLE"}],
        "dateTimeFieldSpecs": [
            {
                "name": "order_ms",
                "dataType": "LONG",
                "format": "1:MILLISECONDS:EPOCH",
                "granularity": "1:DAYS",
            }
        ],
    }
)


def layout_json(table: str, column: str, function: str, partitions: int) -> str:
    entry = {"functionName": function, "numPartitions": partitions}
    config = {
        "tableName": table,
        "segmentsConfig": {"timeColumnName": "order_ms"},
        "tableIndexConfig": {"segmentPartitionConfig": {"columnPartitionMap": {column: entry}}},
    }
    return json.dumps({"tableName": table, "offline": config, "realtime": None})


ORDERS_QUERY = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
       unix_millis(cast(o.o_orderdate AS timestamp)) AS order_ms
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment <> 'BUILDING'
"""

FOLD = PartitionSpec("o_custkey", "hashcode", 12, 5)
DEAL = PartitionSpec("o_orderkey", "modulo", 4, 13)
BY_TYPE = PartitionSpec("event_type", "murmur", 8, 16)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


# --- sources ---------------------------------------------------------------------------------


def query_extract(spark, sf_dir):
    register(spark, sf_dir)
    return extract(
        spark,
        """
        SELECT n.n_name, o.o_orderstatus, count(*) AS n_orders,
               cast(sum(cast(o.o_totalprice AS decimal(18,2))) AS double) AS total
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE o.o_orderpriority <> '5-LOW'
        GROUP BY n.n_name, o.o_orderstatus;
        """,
    )


def extract_validate(spark, sf_dir):
    """Which queries, destinations and formats a run takes, and the rows that those it takes give."""
    register(spark, sf_dir)
    orders, found = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'", []
    for query, to, fmt in ((orders, "a", "json"), (f" {orders} ;\n", "b/", "Parquet"), (" \n", "c", "json"), (orders, " ", "json"), (orders, "d", "avro"), (orders, "e", "csv"), (orders, "f", "")):
        case = f"{len(found)}: {fmt or 'no format'}"
        try:
            rows = extract(spark, query)
            path = stage(rows, f"{fresh_path(spark, 'extract')}/{to}" if to.strip() else to, fmt)
            found.append(scan(spark, path, fmt, rows.schema).agg(F.lit(case).alias("case"), F.lit(True).alias("taken"), F.count(F.lit(1)).alias("n")))
        except (ValueError, NotImplementedError):
            found.append(table(spark, sf_dir, "orders").agg(F.lit(case).alias("case"), F.lit(False).alias("taken"), F.count_if(F.lit(False)).alias("n")))
    return scan_many(found)


def stage_json(spark, sf_dir):
    source = table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return scan(spark, stage(source, fresh_path(spark, "json"), "json"), "json", source.schema)


def stage_json_text(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    return scan(spark, stage(source, fresh_path(spark, "json"), "JSON"), "json", source.schema)


def stage_json_nested(spark, sf_dir):
    source = table(spark, sf_dir, "embeddings")
    back = scan(spark, stage(source, fresh_path(spark, "json"), "json"), "json", source.schema)
    values = back.select("vec_id", "label", F.posexplode("embedding").alias("place", "x"))
    return values.withColumn("x", F.col("x").cast("double"))


def stage_parquet(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    return scan(spark, stage(source, fresh_path(spark, "parquet"), "parquet"), "parquet")


def format_dispatch(spark, sf_dir):
    source = table(spark, sf_dir, "customer")
    staged = []
    for name in ("JSON", "json", "Parquet", " PARQUET "):
        path = stage(source, fresh_path(spark, "format"), name)
        rows = scan(spark, path, name, source.schema)
        staged.append(rows.agg(F.lit(name.strip()).alias("format"), F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")))
    return scan_many(staged)


def scan_json(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    path = stage(source, fresh_path(spark, "json"), "json")
    return scan(spark, path, "json", source.select("o_orderkey", "o_orderstatus").schema.add("o_clerk", "string"))


def scan_parquet(spark, sf_dir):
    source = scan(spark, f"{sf_dir}/lineitem.parquet", "parquet")
    return (
        source.where(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))
    )


def scan_prefix(spark, sf_dir):
    source, root = table(spark, sf_dir, "orders"), fresh_path(spark, "prefix")
    for i, status in enumerate(("F", "O", "P")):
        stage(source.where(F.col("o_orderstatus") == status), f"{root}/{'deeper/' * i}{status}", "parquet")
    return scan(spark, root, "parquet", source.schema, recursive=True)


def scan_dir(spark, sf_dir):
    source, root = table(spark, sf_dir, "orders"), fresh_path(spark, "dir")
    stage(source.where("o_orderstatus = 'F'"), root, "parquet")
    stage(source.where("o_orderstatus = 'O'"), f"{root}/below", "parquet")
    stage(source.where("o_orderstatus = 'P'"), f"{root}/o_orderstatus=F", "parquet")
    return scan(spark, root, "parquet", source.schema, recursive=False)


def scan_concat(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return scan_many([customers, suppliers])


def scan_empty(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    nothing = scan(spark, fresh_path(spark, "missing"), "parquet", source.schema)
    return scan_many([source, nothing])


def input_file_stats_query(spark, sf_dir):
    """Files and rows of the orders staged in seven files."""
    staged = stage(table(spark, sf_dir, "orders").repartition(7), fresh_path(spark, "files"), "parquet")
    rows = scan(spark, staged, "parquet").agg(F.count(F.lit(1)).alias("row_count"))
    files = input_file_stats(spark, staged).select("file_count")
    return files.crossJoin(rows)


# --- schema, projection, key -----------------------------------------------------------------


def typed_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "*", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("order_ms")
    )


def table_schema(spark, sf_dir):
    schema = load_schema(ORDERS_SCHEMA)
    rows = project_physical(typed_orders(spark, sf_dir), schema)
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.metadata["role"]).alias("role"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).isNotNull().cast("long").alias("filled"),
        )
        for f in schema.fields
    ]
    return rows.select(F.inline(F.array(*entries))).groupBy("column_name", "role", "data_type").agg(F.sum("filled").alias("filled"))


def table_layout(spark, sf_dir):
    layout = load_layout(layout_json("customer_OFFLINE", "c_name", "Murmur", 6))
    return (
        with_partition_id(table(spark, sf_dir, "customer"), layout.partition_column, layout.partition_function, layout.partition_count)
        .groupBy("pid")
        .agg(F.count(F.lit(1)).alias("n"), F.lit(layout.table_name).alias("table_name"))
    )


def project_physical_query(spark, sf_dir):
    schema = load_schema(ORDERS_SCHEMA)
    rows = project_physical(table(spark, sf_dir, "orders"), schema, keep=["o_orderdate"])
    return rows.withColumn("order_ms", F.col("order_ms").isNull())


def conform_types_query(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE cast(unix_millis(cast(o_orderdate AS timestamp)) AS string) END").alias("order_ms"),
    )
    return conform_types(texts, load_schema(ORDERS_SCHEMA), strict=False)


def part_rejects_query(spark, sf_dir):
    """Orders as JSON texts, some keys and prices of which are no numbers; good rows and bad ones with their reasons."""
    texts = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey AS string) AS o_custkey",
        "CASE WHEN o_orderkey % 11 = 0 THEN concat('#', o_orderkey) ELSE cast(o_orderkey AS string) END AS o_orderkey",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 5 = 0 THEN NULL ELSE '12.5' END AS o_totalprice",
        "o_orderpriority",
        "cast(o_orderkey AS string) AS line",
    )
    source = scan(spark, stage(texts, fresh_path(spark, "texts"), "json"), "json", texts.schema)
    good, bad = part_rejects(source, load_schema(ORDERS_SCHEMA), fresh_path(spark, "parted"), keep=["line"])
    reasons = F.array_join(F.transform("reasons", lambda r: F.concat_ws(" ", r.column_name, r.value, r.wanted)), "; ")
    columns = ["line", "o_custkey", "o_orderkey", "o_totalprice"]
    return good.select(*columns, F.lit("").alias("reasons")).unionByName(
        bad.where(F.col("source_file").isNotNull()).select(*columns, reasons.alias("reasons"))
    )


def event_time_query(spark, sf_dir):
    field = load_schema(ORDERS_SCHEMA)["order_ms"]
    return (
        typed_orders(spark, sf_dir)
        .select("o_orderkey", event_time(field).cast("timestamp_ntz").alias("event_time"))
    )


def time_bucket_query(spark, sf_dir):
    """Events by quarter of a day, from their time as seconds and as text."""
    made = []
    for kind, fmt, source in (
        ("LONG", "1:SECONDS:EPOCH", "unix_seconds(cast(ts AS timestamp))"),
        ("STRING", "1:MINUTES:SIMPLE_DATE_FORMAT:dd/MM/yyyy HH:mm", "date_format(cast(ts AS timestamp), 'dd/MM/yyyy HH:mm')"),
    ):
        document = {"dateTimeFieldSpecs": [{"name": "at", "dataType": kind, "format": fmt, "granularity": "6:HOURS"}]}
        field = load_schema(json.dumps(document))["at"]
        rows = table(spark, sf_dir, "events").selectExpr(f"{source} AS at")
        buckets = rows.groupBy(time_bucket(field).cast("timestamp_ntz").alias("bucket"), bucket_number(field).alias("number"))
        made.append(buckets.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n")))
    return scan_many(made)


def partition_key_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.expr("nullif(event_type, 'error')"))
    return events.groupBy(partition_key(F.col("k")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


# --- partition functions ---------------------------------------------------------------------


def two_keys(spark, sf_dir, function) -> DataFrame:
    """Customers by a text key and by a whole-number key, made negative for some."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", ((F.col("c_custkey") - 500) * 1234567891).alias("number")
    )
    rows = with_partition_id(rows, "c_name", function, 9, "name_pid")
    return with_partition_id(rows, "number", function, 9, "number_pid")


def pid_hashcode(spark, sf_dir):
    return two_keys(spark, sf_dir, "HashCode")


def pid_hashcode_text(spark, sf_dir):
    rows = with_partition_id(table(spark, sf_dir, "documents"), "text", "hashcode", 101)
    return rows.select("doc_id", "pid")


def pid_murmur(spark, sf_dir):
    return two_keys(spark, sf_dir, "Murmur")


def pid_murmur_text(spark, sf_dir):
    rows = with_partition_id(table(spark, sf_dir, "documents"), "text", "murmur", 101)
    return rows.select("doc_id", "pid")


def pid_modulo(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") - 700).alias("shifted"))
    rows = with_partition_id(rows, "shifted", "Modulo", 7)
    return rows.withColumn("text_pid", partition_id(F.col("shifted").cast("string"), "modulo", 7))


def resolve_partition_fn(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    for alias, name in (("unset", None), ("blank", " "), ("upper", "HASHCODE"), ("murmur", "Murmur"), ("modulo", "modulo")):
        rows = with_partition_id(rows, "c_custkey", name, 6, alias)
    return rows


# --- assignment ------------------------------------------------------------------------------


def partition_spec_query(spark, sf_dir):
    layout = load_layout(layout_json(TABLE, "o_custkey", "Modulo", 6))
    orders = table(spark, sf_dir, "orders")
    counts = []
    for wanted in (0, 4):
        spec = partition_spec(layout, wanted)
        rows = assign_segments(orders, spec)
        counts.append(segment_record_count(rows).withColumn("segments", F.lit(spec.segment_count)))
    return scan_many(counts)


def assign_unpartitioned(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "orders"), PartitionSpec(None, None, 1, 4))
    return emit_empty_segments(segment_record_count(rows), 4)


def assign_fold(spark, sf_dir):
    return assign_segments(table(spark, sf_dir, "orders"), FOLD).select("o_orderkey", "pid", "segment_id")


def assign_block_rr(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "orders"), DEAL, ["o_orderkey"])
    return rows.select("o_orderkey", "pid", "segment_id")


def assign_block_rr_cells(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "orders"), DEAL, ["o_orderkey"], CELL)
    return rows.select("o_orderkey", "pid", "segment_id")


def assign_block_rr_hot_key(spark, sf_dir):
    spec = PartitionSpec("event_type", "hashcode", 3, 20)
    rows = assign_segments(table(spark, sf_dir, "events"), spec, ["ts", "event_id"], CELL)
    return rows.select("event_id", "pid", "segment_id")


def assign_block_rr_copies(spark, sf_dir):
    spec = PartitionSpec("l_orderkey", "hashcode", 4, 10)
    rows = assign_segments(table(spark, sf_dir, "lineitem"), spec, ["l_returnflag"], CELL * 5)
    return segment_record_count(rows)


def assign_block_rr_stable(spark, sf_dir):
    """Rows that land elsewhere when cells are smaller; the order key is far from unique."""
    spec = PartitionSpec("l_orderkey", "hashcode", 4, 10)
    rows = [assign_segments(table(spark, sf_dir, "lineitem"), spec, ["l_returnflag"], n) for n in (CELL, 10_000_000)]
    moved = rows[0].exceptAll(rows[1]).agg(F.count(F.lit(1)).alias("moved_rows"))
    return rows[0].agg(F.count(F.lit(1)).alias("dealt_rows")).crossJoin(moved)


def assign_block_rr_text_order(spark, sf_dir):
    """Documents dealt in the order of their whole texts; the partition goes along with the source."""
    rows = assign_segments(table(spark, sf_dir, "documents"), PartitionSpec("source", "hashcode", 3, 8), ["text", "doc_id"], 50)
    return rows.select("doc_id", "pid", "segment_id")


def segment_block(spark, sf_dir):
    spec = PartitionSpec("o_custkey", "modulo", 5, 13)
    first, end = segment_range(F.col("pid"), spec)
    pids = with_partition_id(table(spark, sf_dir, "orders"), "o_custkey", "modulo", 5).groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    return pids.select("pid", "n", first.alias("first_segment"), end.alias("end_segment"), F.explode(F.sequence(first, end - 1)).alias("segment_id"))


# --- routing and sinks -----------------------------------------------------------------------


def dealt_orders(spark, sf_dir) -> DataFrame:
    return assign_segments(table(spark, sf_dir, "orders"), DEAL, ["o_orderkey"], CELL)


def route_parquet(spark, sf_dir):
    path = route(dealt_orders(spark, sf_dir), fresh_path(spark, "route"), "parquet", DEAL)
    return scan_segments(spark, path)


def route_json(spark, sf_dir):
    source = table(spark, sf_dir, "documents")
    spec = PartitionSpec("source", "hashcode", 16, 6)
    path = route(assign_segments(source, spec), fresh_path(spark, "route"), "json", spec)
    return spark.read.schema(source.schema).json(path)


def segment_name_query(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "orders"), FOLD)
    return segment_record_count(rows).select(segment_name(TABLE, KEY, F.col("segment_id")).alias("segment_name"), "record_count")


def write_segments_query(spark, sf_dir):
    path = fresh_path(spark, "segments")
    orders = assign_segments(table(spark, sf_dir, "orders"), FOLD)
    write_segments(orders, path, FOLD)
    # The second run has no rows for some segments of the first; they must not survive.
    write_segments(orders.where("segment_id % 2 = 0"), path, FOLD)
    return scan_segments(spark, path)


def write_segments_direct(spark, sf_dir):
    path = write_segments(dealt_orders(spark, sf_dir), fresh_path(spark, "segments"), DEAL, gather=False)
    return scan_segments(spark, path)


def emit_empty_segments_query(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "events"), PartitionSpec("event_type", "murmur", 16, 16))
    return emit_empty_segments(segment_record_count(rows), 16)


def target_folder_query(spark, sf_dir):
    folder = target_folder(shared_root(spark) + "/", TABLE, KEY)
    path = write_segments(assign_segments(table(spark, sf_dir, "orders"), FOLD), folder, FOLD)
    named = F.col("_metadata.file_path").rlike(f"[^/]/{TABLE}/segments_{KEY}-[0-9a-f]{{8}}/segment_id=")
    return scan_segments(spark, path).groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("n"), F.every(named).alias("named")
    )


def clean_target_query(spark, sf_dir):
    root = fresh_path(spark, "clean")
    orders = assign_segments(table(spark, sf_dir, "orders"), FOLD)
    write_segments(orders.where("o_orderstatus = 'F'"), f"{root}/old", FOLD)
    write_segments(orders.where("o_orderstatus <> 'F'"), f"{root}/new", FOLD)
    clean_target(spark, f"{root}/old")
    clean_target(spark, f"{root}/never-written")
    return scan(spark, root, "parquet", table(spark, sf_dir, "orders").schema)


def scheme_dispatch(spark, sf_dir):
    customers, root = table(spark, sf_dir, "customer"), fresh_path(spark, "scheme")
    plain = root.removeprefix("file://").removeprefix("file:")
    first = stage(customers, root, "parquet")
    second = stage(customers, f"{plain}-again", "parquet")
    return scan_many([scan(spark, p, "parquet") for p in (first, second)]).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n")
    )


# --- aggregation and manifest ----------------------------------------------------------------


def input_record_count_query(spark, sf_dir):
    return input_record_count(table(spark, sf_dir, "lineitem"))


def segment_record_count_query(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "lineitem"), PartitionSpec("l_partkey", "murmur", 32, 10))
    return segment_record_count(rows)


def written_orders(spark, sf_dir) -> str:
    return write_segments(dealt_orders(spark, sf_dir), fresh_path(spark, "segments"), DEAL)


def segment_byte_size_query(spark, sf_dir):
    sizes = segment_byte_size(spark, written_orders(spark, sf_dir))
    return sizes.select("segment_id", (F.col("byte_size") > 0).alias("has_bytes"), (F.col("file_count") > 0).alias("has_files"))


def segment_manifest_query(spark, sf_dir):
    spec = PartitionSpec("event_type", "murmur", 16, 16)
    events = table(spark, sf_dir, "events")
    path = write_segments(assign_segments(events, spec), fresh_path(spark, "segments"), spec)
    manifest = segment_manifest(spark, path, "events_OFFLINE", KEY, 16)
    return manifest.select(
        "segment_id",
        "segment_name",
        F.regexp_extract("segment_uri", "[^/]+$", 0).alias("folder"),
        "record_count",
        (F.col("byte_size") > 0).alias("has_bytes"),
        (F.col("file_count") > 0).alias("has_files"),
    )


def generation_summary_query(spark, sf_dir):
    path = written_orders(spark, sf_dir)
    manifest = segment_manifest(spark, path, TABLE, KEY, DEAL.segment_count)
    summary = generation_summary(manifest, table(spark, sf_dir, "orders"), f"{sf_dir}/orders.parquet")
    return summary.select(
        "segment_count",
        "record_count",
        "input_record_count",
        (F.col("byte_size") > 0).alias("has_bytes"),
        (F.col("input_byte_size") > 0).alias("has_input_bytes"),
    )


def reconcile_query(spark, sf_dir):
    written = scan_segments(spark, written_orders(spark, sf_dir))
    return reconcile(table(spark, sf_dir, "orders"), segment_record_count(written))


def stats_source(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderdate",
    )
    return assign_segments(orders, FOLD)


def segment_column_stats_query(spark, sf_dir):
    return segment_column_stats(stats_source(spark, sf_dir), exact=True)


def segment_column_stats_estimated(spark, sf_dir):
    """The estimate lies within a fifth of the exact count (four standard errors)."""
    source = stats_source(spark, sf_dir)
    exact = segment_column_stats(source, exact=True).select("segment_id", "column_name", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.2 * F.col("exact")
    return segment_column_stats(source).join(exact, ["segment_id", "column_name"]).withColumn("close", close).drop("distinct_count", "exact")


def merged_sketches(spark, sf_dir):
    """Sketches of two runs' segments merged: distinct counts within 5 %, medians within 3 % of ranks."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")).drop("o_orderpriority")
    runs = [segment_sketches(assign_segments(orders.where(f"o_orderkey % 2 = {k}"), FOLD)) for k in (0, 1)]
    merged = sketch_estimates(merge_sketches(scan_many(runs)), [0.5])
    exact = segment_column_stats(orders.withColumn("segment_id", F.lit(0)), exact=True).select("column_name", "distinct_count")
    numbers = {c: F.col(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")}
    numbers["o_orderdate"] = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), v.cast("double").alias("x")) for c, v in numbers.items()]))
    below = orders.select(values).join(merged.select("column_name", F.get("quantiles", F.lit(0)).alias("median")), "column_name")
    ranks = below.groupBy("column_name").agg(F.avg((F.col("x") <= F.col("median")).cast("int")).alias("upto"), F.avg((F.col("x") < F.col("median")).cast("int")).alias("under"))
    return (
        merged.join(exact, "column_name")
        .join(ranks, "column_name", "left")
        .select(
            "column_name",
            "record_count",
            "null_count",
            (F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")).alias("distinct_close"),
            F.coalesce((F.col("upto") >= 0.47) & (F.col("under") <= 0.53), F.lit(True)).alias("median_close"),
        )
    )


def segment_time_range_query(spark, sf_dir):
    return segment_time_range(assign_segments(table(spark, sf_dir, "events"), BY_TYPE, ["event_id"]), F.col("ts"))


def segment_balance_query(spark, sf_dir):
    spec = PartitionSpec("user_id", "hashcode", 8, 30)
    return segment_balance(assign_segments(table(spark, sf_dir, "events"), spec, ["event_id"]), spec)


def segment_fill_query(spark, sf_dir):
    rows = assign_segments(table(spark, sf_dir, "events"), PartitionSpec("event_type", "hashcode", 16, 16))
    return segment_fill(rows, 16)


def segment_purity_query(spark, sf_dir):
    return segment_purity(assign_segments(table(spark, sf_dir, "orders"), FOLD))


# --- segment reads ---------------------------------------------------------------------------


def segment_prune(spark, sf_dir):
    events = assign_segments(table(spark, sf_dir, "events"), BY_TYPE, ["event_id"])
    path = write_segments(events, fresh_path(spark, "segments"), BY_TYPE)
    return prune_segments(scan_segments(spark, path), BY_TYPE, ["error", "click"]).drop("segment_id")


def pruned_by(key: str, pick: str, columns: str = "o_orderkey", source: str = "orders") -> Query:
    """Reads the rows whose key is that of some picked rows; the key is of a type with a text form of its own."""

    def query(spark, sf_dir):
        spec = PartitionSpec("k", "murmur", 8, 8)
        rows = table(spark, sf_dir, source).select(columns, F.expr(key).alias("k"))
        path = write_segments(assign_segments(rows, spec), fresh_path(spark, "segments"), spec)
        return prune_by_keys(scan_segments(spark, path), spec, rows.where(pick), "k").select(columns)

    return query


def segment_prune_boolean(spark, sf_dir):
    spec = PartitionSpec("k", "murmur", 8, 8)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("k"))
    path = write_segments(assign_segments(rows, spec), fresh_path(spark, "segments"), spec)
    return prune_segments(scan_segments(spark, path), spec, [True]).select("o_orderkey")


def segment_prune_key_table(spark, sf_dir):
    """Orders of the customers of one market, dealt to more segments than partitions."""
    spec = PartitionSpec("o_custkey", "hashcode", 5, 12)
    orders = assign_segments(table(spark, sf_dir, "orders"), spec, ["o_orderkey"])
    path = write_segments(orders, fresh_path(spark, "segments"), spec)
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY' AND c_nationkey < 9")
    return prune_by_keys(scan_segments(spark, path), spec, wanted, "c_custkey").drop("segment_id")


MONTHLY = PartitionSpec("month", "modulo", 24, 24)
PLACED = {"dateTimeFieldSpecs": [{"name": "order_ms", "dataType": "LONG", "format": "1:MILLISECONDS:EPOCH", "granularity": "30:DAYS"}]}


def orders_by_month(spark, sf_dir) -> DataFrame:
    """Orders whose partition is the number of their 30 days, so that a segment holds few spans of time."""
    field = load_schema(json.dumps(PLACED))["order_ms"]
    rows = typed_orders(spark, sf_dir).withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
    return assign_segments(rows.withColumn("month", bucket_number(field)), MONTHLY).where("month < 322")


def day(text: str) -> int:
    return int(datetime.fromisoformat(f"{text}T00:00:00+00:00").timestamp() * 1000)


CONDITIONS: dict[str, Condition] = {
    "range": between("order_ms", day("1995-03-01"), day("1995-05-01")),
    "or": Compare("order_ms", "<", day("1995-01-20")) | Compare("o_totalprice", "<", 1100),
    "not": Not(Compare("order_ms", ">=", day("1995-02-01")) | Missing("o_orderstatus")),
    "null": Missing("o_orderstatus") & Compare("o_orderkey", "=", 77),
}


def zone_prune(spark, sf_dir):
    path = write_segments(orders_by_month(spark, sf_dir), fresh_path(spark, "segments"), MONTHLY)
    zones = write_zones(spark, path)
    rows = [prune_by_zones(scan_segments(spark, path), zones, c, 24).withColumn("condition", F.lit(n)) for n, c in CONDITIONS.items()]
    return scan_many(rows).select("condition", "o_orderkey", "segment_id")


def zone_segments_query(spark, sf_dir):
    """The segments that each condition has to read."""
    path = write_segments(orders_by_month(spark, sf_dir), fresh_path(spark, "segments"), MONTHLY)
    zones, kinds = write_zones(spark, path), scan_segments(spark, path).schema
    return scan_many([zone_segments(zones, c, kinds).withColumn("condition", F.lit(n)) for n, c in CONDITIONS.items()])


def member_prune(spark, sf_dir):
    """Orders by price, which is not their partition key, from the segments whose filters may hold the price."""
    path = write_segments(assign_segments(table(spark, sf_dir, "orders"), FOLD), fresh_path(spark, "segments"), FOLD)
    sketch = write_members(spark, path, ["o_totalprice", "o_orderdate"])
    wanted = table(spark, sf_dir, "orders").where("o_orderkey % 499 = 3")
    df = scan_segments(spark, path)
    by_price = prune_by_members(df, sketch, "o_totalprice", wanted, "o_totalprice", 5).withColumn("by", F.lit("price"))
    by_date = prune_by_members(df, sketch, "o_orderdate", wanted, "o_orderdate", 5).withColumn("by", F.lit("date"))
    return by_price.unionByName(by_date)


# --- generations -----------------------------------------------------------------------------


def two_generations(spark, sf_dir) -> tuple[str, DataFrame]:
    """A table after two whole runs and two broken ones; the second run changes the orders of one segment."""
    folder, orders = fresh_path(spark, "table"), assign_segments(table(spark, sf_dir, "orders"), FOLD)
    write_generation(orders, folder, FOLD, TABLE, KEY)
    write_segments(orders.where("o_orderstatus = 'F'"), f"{folder}/_data/{KEY}-broken", FOLD)

    def refuse(manifest):
        raise RuntimeError("the run ends before its commit")

    changed = orders.withColumn("o_totalprice", F.expr("CASE WHEN segment_id = 3 THEN o_totalprice * 2 ELSE o_totalprice END"))
    try:
        write_generation(orders.limit(0), folder, FOLD, TABLE, KEY, refuse)
    except RuntimeError:
        write_generation(changed, folder, FOLD, TABLE, KEY)
    return folder, orders


def generation_rows(spark, sf_dir):
    folder, orders = two_generations(spark, sf_dir)
    return scan_generation(spark, folder, orders.drop("pid").schema)


def generation_changes(spark, sf_dir):
    """Segments that the second run wrote, with their rows."""
    folder, orders = two_generations(spark, sf_dir)
    rows = scan_generation(spark, folder, orders.drop("pid").schema)
    return segment_record_count(rows).join(changed_segments(spark, folder), "segment_id")


def segment_scan(spark, sf_dir):
    return scan_segments(spark, written_orders(spark, sf_dir), [0, 5, 12])


# --- payload and publish plan ----------------------------------------------------------------

TEMPLATE = (
    '{"part": "${segmentName}", "of": "${tableName}", "rows": ${ outputRecordCount }, "all_rows": ${inputRecordCount}}'
)


def described(spark, sf_dir, template) -> DataFrame:
    path = written_orders(spark, sf_dir)
    manifest = segment_manifest(spark, path, TABLE, KEY, DEAL.segment_count)
    summary = generation_summary(manifest, table(spark, sf_dir, "orders"), f"{sf_dir}/orders.parquet")
    remote = F.concat(F.lit("s3a://bucket/"), F.regexp_extract("segment_uri", "[^/]+$", 0))
    return with_payload(with_input_totals(manifest, summary), TABLE, template).withColumn("segment_uri", remote)


def render_payload_query(spark, sf_dir):
    manifest = described(spark, sf_dir, TEMPLATE).select("segment_id", "payload")
    return manifest.join(described(spark, sf_dir, None).select("segment_id", F.col("payload").alias("without_template")), "segment_id")


def publish_plan_query(spark, sf_dir):
    manifest = described(spark, sf_dir, TEMPLATE)
    return scan_many([publish_plan(manifest, mode, delay) for mode, delay in (("METADATA", 30), ("URI", 0), ("FILE", -5))])


def publish_validate(spark, sf_dir):
    manifest = described(spark, sf_dir, None).withColumn(
        "segment_uri",
        F.when(F.col("segment_id") % 4 == 1, F.lit(None))
        .when(F.col("segment_id") % 4 == 2, F.lit("file:/tmp/x"))
        .otherwise(F.col("segment_uri")),
    )
    plans = scan_many([publish_plan(manifest, mode) for mode in ("METADATA", "FILE")])
    return publish_problems(plans).select("push_order", "segment_name", "upload_mode", "problem")


# --- whole run -------------------------------------------------------------------------------


def run_job(spark, sf_dir, **options):
    register(spark, sf_dir)
    layout = load_layout(layout_json(TABLE, "o_custkey", "Murmur", 4))
    return run_segment_job(spark, ORDERS_QUERY, load_schema(ORDERS_SCHEMA), layout, KEY, fresh_path(spark, "job"), **options)


def segment_job(spark, sf_dir):
    job = run_job(spark, sf_dir, segment_count=10, order_by=["o_orderkey"])
    return job.manifest.select("segment_id", "segment_name", "record_count", (F.col("byte_size") > 0).alias("has_bytes"))


def segment_job_rows(spark, sf_dir):
    job = run_job(spark, sf_dir, segment_count=10, order_by=["o_orderkey"])
    return scan_segments(spark, job.target)


def segment_job_json_rows(spark, sf_dir):
    job = run_job(spark, sf_dir, fmt="json", segment_count=3)
    return scan_segments(spark, job.target)


def segment_job_json_dealt(spark, sf_dir):
    job = run_job(spark, sf_dir, fmt="json", segment_count=10)
    return job.manifest.select("segment_id", "segment_name", "record_count", (F.col("byte_size") > 0).alias("has_bytes"))


def segment_job_json_dealt_rows(spark, sf_dir):
    """All rows once, whatever turn they got; their segments belong to the partition of their key."""
    job = run_job(spark, sf_dir, fmt="json", segment_count=10)
    rows = with_partition_id(scan_segments(spark, job.target), "o_custkey", "murmur", 4)
    first, end = segment_range(F.col("pid"), job.spec)
    return rows.withColumn("own", F.col("segment_id").between(first, end - 1)).drop("segment_id")


def segment_job_generations(spark, sf_dir):
    """A job run twice as generations, with fewer rows the second time."""
    register(spark, sf_dir)
    layout, base = load_layout(layout_json(TABLE, "o_custkey", "Murmur", 4)), fresh_path(spark, "job")
    for where in ("", " AND o_orderkey % 4 <> 1"):
        job = run_segment_job(spark, ORDERS_QUERY + where, load_schema(ORDERS_SCHEMA), layout, KEY, base, segment_count=3, generations=True)
    counts = job.manifest.select("segment_id", F.col("record_count").alias("listed"))
    return scan_generation(spark, job.target, load_schema(ORDERS_SCHEMA)).join(counts, "segment_id")


def segment_job_statistics(spark, sf_dir):
    job = run_job(spark, sf_dir, segment_count=3, index=["order_ms"])
    zones = job.zones.select("segment_id", F.col("zones.order_ms.least").cast("string").alias("zone_least"))
    return job.statistics.drop("distinct_count").join(zones, "segment_id")


def segment_job_file_order(spark, sf_dir):
    job = run_job(spark, sf_dir, segment_count=10)
    return job.manifest.select("segment_id", "segment_name", "record_count", (F.col("byte_size") > 0).alias("has_bytes"))


QUERIES: dict[str, Query] = {
    "query_extract": query_extract,
    "extract_validate": extract_validate,
    "stage_json": stage_json,
    "stage_json_text": stage_json_text,
    "stage_json_nested": stage_json_nested,
    "stage_parquet": stage_parquet,
    "format_dispatch": format_dispatch,
    "scan_json": scan_json,
    "scan_parquet": scan_parquet,
    "scan_prefix": scan_prefix,
    "scan_dir": scan_dir,
    "scan_concat": scan_concat,
    "scan_empty": scan_empty,
    "input_file_stats": input_file_stats_query,
    "table_schema": table_schema,
    "table_layout": table_layout,
    "project_physical": project_physical_query,
    "conform_types": conform_types_query,
    "part_rejects": part_rejects_query,
    "event_time": event_time_query,
    "time_bucket": time_bucket_query,
    "partition_key": partition_key_query,
    "pid_hashcode": pid_hashcode,
    "pid_hashcode_text": pid_hashcode_text,
    "pid_murmur": pid_murmur,
    "pid_murmur_text": pid_murmur_text,
    "pid_modulo": pid_modulo,
    "resolve_partition_fn": resolve_partition_fn,
    "partition_spec": partition_spec_query,
    "assign_unpartitioned": assign_unpartitioned,
    "assign_fold": assign_fold,
    "assign_block_rr": assign_block_rr,
    "assign_block_rr_cells": assign_block_rr_cells,
    "assign_block_rr_hot_key": assign_block_rr_hot_key,
    "assign_block_rr_copies": assign_block_rr_copies,
    "assign_block_rr_stable": assign_block_rr_stable,
    "assign_block_rr_text_order": assign_block_rr_text_order,
    "segment_block": segment_block,
    "route_parquet": route_parquet,
    "route_json": route_json,
    "segment_name": segment_name_query,
    "write_segments": write_segments_query,
    "write_segments_direct": write_segments_direct,
    "emit_empty_segments": emit_empty_segments_query,
    "target_folder": target_folder_query,
    "clean_target": clean_target_query,
    "scheme_dispatch": scheme_dispatch,
    "input_record_count": input_record_count_query,
    "segment_record_count": segment_record_count_query,
    "segment_byte_size": segment_byte_size_query,
    "segment_manifest": segment_manifest_query,
    "generation_summary": generation_summary_query,
    "reconcile": reconcile_query,
    "segment_column_stats": segment_column_stats_query,
    "segment_column_stats_estimated": segment_column_stats_estimated,
    "merged_sketches": merged_sketches,
    "segment_time_range": segment_time_range_query,
    "segment_balance": segment_balance_query,
    "segment_fill": segment_fill_query,
    "segment_purity": segment_purity_query,
    "segment_prune": segment_prune,
    "segment_prune_double": pruned_by("o_totalprice", "o_orderkey % 997 = 1"),
    "segment_prune_decimal": pruned_by("cast(o_totalprice as decimal(12,2))", "o_orderkey % 997 = 1"),
    "segment_prune_boolean": segment_prune_boolean,
    "segment_prune_date": pruned_by("cast(o_orderdate as date)", "o_orderkey % 499 = 1"),
    "segment_prune_key_table": segment_prune_key_table,
    "zone_prune": zone_prune,
    "zone_segments": zone_segments_query,
    "member_prune": member_prune,
    "generation_rows": generation_rows,
    "generation_changes": generation_changes,
    "segment_prune_timestamp": pruned_by("ts", "event_id % 997 = 1", "event_id", "events"),
    "segment_scan": segment_scan,
    "render_payload": render_payload_query,
    "publish_plan": publish_plan_query,
    "publish_validate": publish_validate,
    "segment_job": segment_job,
    "segment_job_rows": segment_job_rows,
    "segment_job_json_rows": segment_job_json_rows,
    "segment_job_file_order": segment_job_file_order,
    "segment_job_json_dealt": segment_job_json_dealt,
    "segment_job_json_dealt_rows": segment_job_json_dealt_rows,
    "segment_job_generations": segment_job_generations,
    "segment_job_statistics": segment_job_statistics,
}
