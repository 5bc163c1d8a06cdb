"""Payloads and the publish plan: what an external pusher would send, as a table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.operators.assign import SEGMENT
from segloom.sources.formats import storage_scheme

MODES = ("FILE", "URI", "METADATA")
DEFAULT_PUSH_DELAY_SECONDS = 30
EMPTY_PAYLOAD = "{}"

# Template variables and the manifest columns they stand for.
TEMPLATE_FIELDS = {
    "inputRecordCount": "input_record_count",
    "inputRecordSize": "input_byte_size",
    "tableName": "table_name",
    "segmentName": "segment_name",
    "outputRecordCount": "record_count",
    "outputRecordSize": "byte_size",
}


def load_template(spark: SparkSession, path: str | None) -> str | None:
    """Template text of ``path``; no path means no template, a missing file fails."""
    if path is None or not path.strip():
        return None
    return spark.read.text(path.strip(), wholetext=True).first()[0]


def render_payload(template: str | None) -> Column:
    """The template with each ``${name}`` replaced by its column, numbers in plain digits."""
    if template is None or not template.strip():
        return F.lit(EMPTY_PAYLOAD)
    # With one group in the pattern, odd pieces are variable names.
    pieces = re.split(r"\$\{\s*(\w+)\s*\}", template)
    unknown = sorted(set(pieces[1::2]) - set(TEMPLATE_FIELDS))
    if unknown:
        raise ValueError(f"unknown template variables: {unknown}")
    parts = [
        F.col(TEMPLATE_FIELDS[piece]).cast("string") if odd % 2 else F.lit(piece)
        for odd, piece in enumerate(pieces)
    ]
    return F.concat(*parts)


def with_input_totals(manifest: DataFrame, summary: DataFrame) -> DataFrame:
    """Add the run's input rows and bytes to every segment row."""
    return manifest.withColumns(
        {c: summary.select(c).scalar() for c in ("input_record_count", "input_byte_size")}
    )


def with_payload(manifest: DataFrame, table: str, template: str | None = None) -> DataFrame:
    """Add ``table_name`` and the rendered ``payload``; needs the columns of with_input_totals."""
    return manifest.withColumn("table_name", F.lit(table)).withColumn("payload", render_payload(template))


def upload_mode(base: str | None, wanted: str | None = None) -> str:
    """FILE for local targets; otherwise URI if asked for, else METADATA."""
    if base is None or not base.strip():
        return "FILE"
    try:
        scheme = storage_scheme(base.strip())
    except ValueError:
        return "FILE"
    if scheme == "file":
        return "FILE"
    return "URI" if (wanted or "").upper() == "URI" else "METADATA"


def table_type(table: Column) -> Column:
    """REALTIME or OFFLINE by the suffix of the table name, OFFLINE without one."""
    return F.when(table.endswith("_REALTIME"), "REALTIME").otherwise("OFFLINE")


def base_table_name(table: Column) -> Column:
    return F.regexp_replace(table, "_(OFFLINE|REALTIME)$", "")


def publish_plan(manifest: DataFrame, mode: str, delay_seconds: int = DEFAULT_PUSH_DELAY_SECONDS) -> DataFrame:
    """One row per push, in segment order; the first goes out at once, each later one after a delay."""
    if mode not in MODES:
        raise ValueError(f"unknown upload mode {mode}, expected one of {MODES}")
    table = F.col("table_name")
    payload = F.col("payload") if mode != "FILE" else F.lit(None).cast("string")
    # Segment ids are dense, so the id is the position: no global window is needed.
    return manifest.select(
        (F.col(SEGMENT) + 1).alias("push_order"),
        "segment_name",
        F.lit(mode).alias("upload_mode"),
        base_table_name(table).alias("base_table_name"),
        table_type(table).alias("table_type"),
        "segment_uri",
        (F.col(SEGMENT).cast("long") * max(delay_seconds, 0)).alias("push_offset_seconds"),
        payload.alias("payload"),
        "record_count",
        # the store fetches a URI push itself; the copy in the target is not needed after that
        F.lit(mode == "URI").alias("delete_after_push"),
    )


def publish_problems(plan: DataFrame) -> DataFrame:
    """Rows of a plan that cannot be pushed, with the reason."""
    missing = F.col("segment_uri").isNull() | (F.trim("segment_uri") == "")
    # A URI without a scheme, or with the local one, cannot be fetched by a remote store.
    local = ~F.col("segment_uri").rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | F.col("segment_uri").startswith("file:")
    remote_mode = F.col("upload_mode") != "FILE"
    reason = (
        F.when(missing & remote_mode, F.lit("no remote location"))
        .when(missing, F.lit("no local path"))
        .when(remote_mode & local, F.lit("location is not remote"))
        .when((F.col("upload_mode") == "METADATA") & F.col("record_count").isNull(), F.lit("no metadata"))
    )
    return plan.withColumn("problem", reason).where(F.col("problem").isNotNull())


def require_publishable(plan: DataFrame) -> DataFrame:
    """The plan itself, after failing on its first bad row if there is one."""
    bad = publish_problems(plan).orderBy("push_order").first()
    if bad is not None:
        raise ValueError(f"cannot publish segment {bad.segment_name}: {bad.problem}")
    return plan
