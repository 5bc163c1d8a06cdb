"""Segment building on Spark: query -> typed rows -> partition id -> segment id -> Parquet layout."""

from segloom.functions.hashing import partition_id, resolve_partition_function
from segloom.functions.keys import partition_key
from segloom.operators.assign import assign_segments, with_partition_id
from segloom.operators.manifest import segment_manifest
from segloom.operators.prune import prune_segments
from segloom.operators.publish import publish_plan, with_payload
from segloom.operators.sink import write_segments
from segloom.plans.job import SegmentJob, run_segment_job
from segloom.sources.extract import extract, stage
from segloom.sources.scan import scan
from segloom.sources.schema import (
    PartitionSpec,
    TableLayout,
    load_layout,
    load_schema,
    partition_spec,
)

__all__ = [
    "PartitionSpec",
    "SegmentJob",
    "TableLayout",
    "assign_segments",
    "extract",
    "load_layout",
    "load_schema",
    "partition_id",
    "partition_key",
    "partition_spec",
    "prune_segments",
    "publish_plan",
    "resolve_partition_function",
    "run_segment_job",
    "scan",
    "segment_manifest",
    "stage",
    "with_partition_id",
    "with_payload",
    "write_segments",
]
