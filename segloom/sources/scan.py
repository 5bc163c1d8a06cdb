"""Reading staged files as one DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from segloom.sources.formats import check_storage, has_avro, readable_format

# Spark error conditions of a missing path and of a folder without data files.
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

ROW_FILE = "__row_file"
ROW_INDEX = "__row_index"


def scan(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | None = None,
    recursive: bool = True,
) -> DataFrame:
    """All records of the files below ``path`` (or directly in it when not ``recursive``).

    A missing or empty path gives zero rows, for which ``schema`` is needed. JSON always
    needs it too: letting Spark infer a schema would read the whole input twice.
    """
    fmt = readable_format(fmt)
    if fmt == "json" and schema is None:
        raise ValueError("scanning JSON needs a schema")
    check_storage(spark, path)
    if fmt == "avro" and not has_avro(spark):
        return _scan_avro_text(spark, path, schema, recursive)
    if not recursive and not direct_files(spark, path):
        if schema is None:
            raise ValueError(f"nothing to read at {path}, and no schema for an empty result")
        return empty(spark, schema)
    reader = spark.read.format(fmt).option("recursiveFileLookup", recursive)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    try:
        return reader.load(path if recursive else direct_files(spark, path))
    except AnalysisException as failure:
        if failure.getCondition() not in NOTHING_THERE:
            raise
        if schema is None:
            raise ValueError(f"nothing to read at {path}, and no schema for an empty result") from failure
        return empty(spark, schema)


def direct_files(spark: SparkSession, path: str) -> list[str]:
    """The data files in a folder itself, or the one file; subfolders are left out whatever they are called."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isFile()]
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def _scan_avro_text(
    spark: SparkSession, path: str, schema: StructType | None, recursive: bool
) -> DataFrame:
    """Avro files without the spark-avro module: Hadoop's input format gives records as JSON.

    It splits files like the module does, but every record passes through Python.
    """
    if schema is None:
        raise ValueError("scanning Avro without the spark-avro module needs a schema")
    # As text these come without their logical type, so a number's meaning would depend on the module.
    unsure = [kind for kind in ("binary", "timestamp", "date", "decimal") if kind in schema.simpleString()]
    if unsure:
        raise NotImplementedError(f"reading Avro {', '.join(unsure)} columns needs the spark-avro module")
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    except AnalysisException as failure:
        if failure.getCondition() not in NOTHING_THERE:
            raise
        return empty(spark, schema)
    records = spark.sparkContext.hadoopRDD(
        "org.apache.avro.mapred.AvroAsTextInputFormat",
        "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.NullWritable",
        conf={
            "mapreduce.input.fileinputformat.inputdir": path.replace(",", "\\,"),
            "mapreduce.input.fileinputformat.input.dir.recursive": str(recursive).lower(),
            "mapreduce.input.fileinputformat.input.dir.nonrecursive.ignore.subdirs": "true",
        },
    )
    lines = spark.createDataFrame(records.map(lambda pair: (pair[0],)), "value string")
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return lines.select(parsed.alias("record")).select("record.*")


def scan_many(frames: list[DataFrame]) -> DataFrame:
    """Several inputs as one row stream; a column that one of them lacks is null there."""
    if not frames:
        raise ValueError("at least one input is required")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_row_position(df: DataFrame) -> DataFrame:
    """Add a number for the file and the row number in it: a repeatable order of a Parquet scan.

    The file number is a hash: paths would travel with every row and are slow to compare.
    """
    return df.select(
        "*",
        F.xxhash64("_metadata.file_path").alias(ROW_FILE),
        F.col("_metadata.row_index").alias(ROW_INDEX),
    )


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file below ``path``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def input_file_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of files below ``path`` and their total bytes."""
    return input_files(spark, path).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("byte_size"),
    )
