"""Table schema and table layout, read from their JSON documents on the driver."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# Data type names of a table schema document.
DATA_TYPES: dict[str, T.DataType] = {
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BIG_DECIMAL": T.DecimalType(38, 18),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "BYTES": T.BinaryType(),
}

# Field lists of a table schema document and the role each gives its columns.
FIELD_LISTS = {
    "dimensionFieldSpecs": "dimension",
    "metricFieldSpecs": "metric",
    "dateTimeFieldSpecs": "dateTime",
}


def load_schema(text: str) -> T.StructType:
    """Table schema JSON -> StructType; role and time format sit in the field metadata."""
    document = json.loads(text)
    fields = []
    for list_name, role in FIELD_LISTS.items():
        for spec in document.get(list_name) or []:
            type_name = str(spec["dataType"]).upper()
            if type_name not in DATA_TYPES:
                raise ValueError(f"unknown data type {spec['dataType']} of column {spec['name']}")
            data_type = DATA_TYPES[type_name]
            if spec.get("singleValueField") is False:
                data_type = T.ArrayType(data_type)
            metadata = {"role": role} | {k: spec[k] for k in ("format", "granularity") if k in spec}
            fields.append(T.StructField(spec["name"], data_type, True, metadata))
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError("a column appears twice in the table schema")
    return T.StructType(fields)


@dataclass(frozen=True)
class TableLayout:
    """Table name, time column and partitioning of a table config."""

    table_name: str
    time_column: str | None = None
    partition_column: str | None = None
    partition_function: str | None = None
    partition_count: int = 1


@dataclass(frozen=True)
class PartitionSpec:
    """How rows map to segments: key column, logical partitions P, physical segments S."""

    column: str | None
    function: str | None
    partition_count: int
    segment_count: int

    def __post_init__(self) -> None:
        object.__setattr__(self, "partition_count", max(self.partition_count, 1))
        object.__setattr__(self, "segment_count", max(self.segment_count, 1))

    @property
    def spreads(self) -> bool:
        """True when a partition owns several segments and rows are dealt among them."""
        return self.column is not None and self.segment_count > self.partition_count


def load_layout(text: str) -> TableLayout:
    """Table config JSON -> TableLayout; a wrapper gives its offline, else realtime, node."""
    document = json.loads(text)
    for node in ("offline", "realtime"):
        if document.get(node) is not None:
            document = document[node]
            break
    validation = document.get("segmentsConfig") or {}
    indexing = document.get("tableIndexConfig") or {}
    partition_map = (indexing.get("segmentPartitionConfig") or {}).get("columnPartitionMap") or {}
    if len(partition_map) > 1:
        raise ValueError(f"only one partition column is supported, got {sorted(partition_map)}")
    for column, entry in partition_map.items():
        return TableLayout(
            document["tableName"],
            validation.get("timeColumnName"),
            column,
            entry.get("functionName"),
            int(entry.get("numPartitions", 1)),
        )
    return TableLayout(document["tableName"], validation.get("timeColumnName"))


def partition_spec(layout: TableLayout, segment_count: int = 0) -> PartitionSpec:
    """Segment count 0 means "one segment per partition"."""
    if segment_count < 0:
        raise ValueError("segment count must be at least 1, or 0 for the table's partition count")
    return PartitionSpec(
        layout.partition_column,
        layout.partition_function,
        layout.partition_count,
        segment_count or layout.partition_count,
    )
