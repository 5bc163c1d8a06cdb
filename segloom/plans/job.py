"""The whole run: query -> staged rows -> segments -> manifest -> publish plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segloom.operators.assign import PID, SEGMENT, assign_segments
from segloom.operators.conform import conform, project_physical
from segloom.operators.generations import (
    Commit,
    generation_manifest,
    scan_generation,
    write_generation,
)
from segloom.operators.manifest import generation_summary, require_reconciled, segment_column_stats, segment_manifest
from segloom.operators.prune import scan_segments
from segloom.operators.publish import (
    DEFAULT_PUSH_DELAY_SECONDS,
    load_template,
    publish_plan,
    require_publishable,
    upload_mode,
    with_input_totals,
    with_payload,
)
from segloom.operators.sink import clean_target, target_folder, write_segments
from segloom.operators.zones import write_zones
from segloom.session import fresh_path, materialise, observed
from segloom.sources.extract import extract, stage
from segloom.sources.scan import ROW_FILE, ROW_INDEX, scan, with_row_position
from segloom.sources.schema import PartitionSpec, TableLayout, partition_spec

# Up to this many segments per partition, a dealt cell still gives each of them a large file.
DIRECT_WRITE_SEGMENTS = 8


@dataclass(frozen=True)
class SegmentJob:
    """Outcome of one run.

    ``statistics`` (per segment and column) are computed when they are used, from the written segments. ``zones`` is the
    zone map of the indexed columns, ``commit`` the generation that the run made the table's content, if asked for.
    """

    spec: PartitionSpec
    target: str
    input_record_count: int
    manifest: DataFrame
    summary: DataFrame
    plan: DataFrame
    statistics: DataFrame
    zones: DataFrame | None = None
    commit: Commit | None = None


def run_segment_job(
    spark: SparkSession,
    query: str,
    schema: StructType,
    layout: TableLayout,
    segment_key: str,
    base: str | None = None,
    fmt: str = "parquet",
    segment_count: int = 0,
    order_by: list[str] | None = None,
    template: str | None = None,
    upload_type: str | None = None,
    push_delay_seconds: int = DEFAULT_PUSH_DELAY_SECONDS,
    staging: str | None = None,
    keep_staging: bool = False,
    template_path: str | None = None,
    index: list[str] | None = None,
    generations: bool = False,
) -> SegmentJob:
    """Stage the query's result, split it into segments below ``base`` and describe them.

    Staging fixes the rows in storage, so the passes of a spreading assignment all see the
    same data; they are removed after the run, whatever its outcome. Without ``order_by`` rows are dealt in
    the order of the staged files, or of their content where rows have no place in a file (JSON). The key is
    brought to its declared type before it is hashed, so that stored values lead back to their segment. A
    plan that could not be published fails the run, and a failed run leaves no segments behind.

    ``template_path`` names a file with the payload template. ``index`` names columns whose zone map is kept
    beside the segments. With ``generations`` the run replaces the content of ``<base>/<table>``: only segments that
    changed are written, and readers see them all at once or not at all; it does not go with ``index``.
    """
    if generations and (index or not (base or "").strip()):
        raise ValueError("generations need a base folder and have no index")
    if template_path is not None:
        if template is not None:
            raise ValueError("give a template or the path of one")
        template = load_template(spark, template_path)
    if not (base or "").strip() and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a base folder that every executor can reach")
    result = extract(spark, query)
    spec = partition_spec(layout, segment_count)
    staged = staging or fresh_path(spark, "staging")
    target = f"{base.strip().rstrip('/')}/{layout.table_name}" if generations else target_folder(base, layout.table_name, segment_key)
    describe = Describe(layout.table_name, segment_key, template, upload_mode(base, upload_type), push_delay_seconds)
    try:
        stage(result, staged, fmt)
        source = scan(spark, staged, fmt, result.schema)
        if generations:
            return _replace(source, staged, spec, schema, target, fmt, order_by, describe)
        return _build(source, staged, spec, schema, target, fmt, order_by, describe, index)
    except Exception:
        if not generations:  # a failed generation removes its own files and leaves the others
            clean_target(spark, target)
        raise
    finally:
        if not keep_staging:
            clean_target(spark, staged)
        clean_target(spark, _dealt(staged))


def _dealt(staged: str) -> str:
    """Where rows lie in the order that they are dealt in."""
    return f"{staged.rstrip('/')}-dealt"


@dataclass(frozen=True)
class Describe:
    """What the publish plan of a run says about its segments."""

    table: str
    segment_key: str
    template: str | None
    mode: str
    delay: int

    def plan(self, manifest: DataFrame, source: DataFrame, staged: str, read: int) -> tuple[DataFrame, DataFrame]:
        """The run's summary and its plan, which fails if it could not be published."""
        summary = materialise(generation_summary(manifest, source, staged, read))
        described = with_payload(with_input_totals(manifest, summary), self.table, self.template)
        return summary, require_publishable(publish_plan(described, self.mode, self.delay))


def _typed(source: DataFrame, spec: PartitionSpec, schema: StructType, order_by: list[str] | None) -> DataFrame:
    # Columns that neither the schema nor the routing needs would only burden the exchange.
    routing = [c for c in dict.fromkeys([spec.column, *(order_by or [])]) if c is not None]
    return conform(source, schema, keep=routing)


def _build(
    source: DataFrame,
    staged: str,
    spec: PartitionSpec,
    schema: StructType,
    target: str,
    fmt: str,
    order_by: list[str] | None,
    describe: Describe,
    index: list[str] | None,
) -> SegmentJob:
    """Everything between the staged rows and the plan; nothing it returns reads them again."""
    spark, rows = source.sparkSession, Observation()
    typed = _typed(source, spec, schema, order_by)
    if not spec.spreads:  # one pass reads the rows and writes them: it counts them as well
        typed = typed.observe(rows, F.count(F.lit(1)).alias("read"))
    assigned = _assign(typed, spec, order_by, fmt, staged)
    few = spec.spreads and -(-spec.segment_count // spec.partition_count) <= DIRECT_WRITE_SEGMENTS
    write_segments(project_physical(assigned, schema, keep=[PID, SEGMENT]), target, spec, gather=not few)
    # One row per segment, used several times below: listed and counted once.
    manifest = materialise(segment_manifest(spark, target, describe.table, describe.segment_key, spec.segment_count))
    read, _ = require_reconciled(source, manifest, None if spec.spreads else observed(rows, "read"))
    summary, plan = describe.plan(manifest, source, staged, read)
    written = _written(scan_segments(spark, target) if read else source.sparkSession.createDataFrame([], schema), schema)
    zones = write_zones(spark, target, index) if index and read else None
    return SegmentJob(spec, target, read, manifest, summary, plan, written, zones)


def _written(rows: DataFrame, schema: StructType) -> DataFrame:
    if SEGMENT not in rows.columns:
        rows = rows.withColumn(SEGMENT, F.lit(0))
    return segment_column_stats(rows, [f.name for f in schema.fields])


def _replace(
    source: DataFrame,
    staged: str,
    spec: PartitionSpec,
    schema: StructType,
    folder: str,
    fmt: str,
    order_by: list[str] | None,
    describe: Describe,
) -> SegmentJob:
    """The run as a generation: reconciled, described and accepted before it is committed."""
    spark, outcome = source.sparkSession, {}
    assigned = _assign(_typed(source, spec, schema, order_by), spec, order_by, fmt, staged)

    def accept(committed: DataFrame) -> None:
        manifest = materialise(generation_manifest(committed, folder, describe.table, describe.segment_key, spec.segment_count))
        read, _ = require_reconciled(source, manifest)
        outcome.update(manifest=manifest, read=read, plan=describe.plan(manifest, source, staged, read))

    rows = project_physical(assigned, schema, keep=[PID, SEGMENT])
    commit = write_generation(rows, folder, spec, describe.table, describe.segment_key, accept)
    statistics = _written(scan_generation(spark, folder, schema, commit), schema)
    summary, plan = outcome["plan"]
    return SegmentJob(spec, folder, outcome["read"], outcome["manifest"], summary, plan, statistics, commit=commit)


def _assign(source: DataFrame, spec: PartitionSpec, order_by: list[str] | None, fmt: str, staged: str) -> DataFrame:
    if order_by or not spec.spreads:
        return assign_segments(source, spec, order_by, staging=_dealt(staged))
    if fmt != "parquet":
        return assign_segments(source, spec, [], staging=_dealt(staged))
    position = [ROW_FILE, ROW_INDEX]
    return assign_segments(with_row_position(source), spec, position, unique=True, staging=_dealt(staged)).drop(*position)
