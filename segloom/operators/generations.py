"""Generations of a table: a run's segments are seen all at once or not at all, and unchanged ones are kept.

Below the table's folder lie

* ``_data/<generation>/segment_id=<id>/``: rows, written first and hidden from plain readers of the folder;
* ``_manifests/<generation>/``: one row per segment that has rows: in which generation's folder it lies, rows, bytes,
  files, and a digest of its content;
* ``_commits/<number>.json``: written last, names the generation. Readers see what the highest commit names.

A run that ends early leaves no commit, so none of its rows is seen. A commit's file is created only if
it is not there yet, so of two runs at once the later one fails (on a store whose create is not exclusive,
let one run at a time).
"""

from __future__ import annotations

import json
import re
import secrets
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segloom.operators.assign import PID, SEGMENT, _hashable
from segloom.operators.manifest import all_segments, segment_manifest
from segloom.operators.prune import WANTED, read_segments
from segloom.operators.sink import clean_target, segment_name, write_segments
from segloom.sources.schema import PartitionSpec

DATA, MANIFESTS, COMMITS = "_data", "_manifests", "_commits"
MANIFEST = T.StructType(
    [
        T.StructField(SEGMENT, T.IntegerType()),
        T.StructField("generation", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in ("record_count", "byte_size", "file_count")],
        T.StructField("digest", T.StringType()),
    ]
)
# Seeds of the two row hashes that a digest sums.
SEEDS = (1, 2)


def segment_digests(df: DataFrame) -> DataFrame:
    """``segment_id``, ``record_count`` and ``digest``: equal for equal rows in any order, one pass without a shuffle of rows.

    Row hashes are summed, not combined bit by bit, so that repeated rows count; columns go by name.
    """
    fields = sorted((f for f in df.schema.fields if f.name not in (PID, SEGMENT)), key=lambda f: f.name)
    # null and absent columns hash alike, so the names belong to the content
    names = F.lit(",".join(f"{f.name}:{f.dataType.simpleString()}" for f in fields))

    def total(seed: int) -> Column:
        row = F.xxhash64(F.lit(seed), names, *[_hashable(f) for f in fields])
        return F.sum(row.cast("decimal(38,0)"))

    count = F.count(F.lit(1))
    digest = F.concat_ws(":", count, *[total(s) for s in SEEDS])
    return df.groupBy(SEGMENT).agg(count.alias("record_count"), digest.alias("digest"))


@dataclass(frozen=True)
class Commit:
    """A committed generation."""

    number: int
    generation: str


def _path(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def commits(spark: SparkSession, folder: str) -> list[Commit]:
    """All commits, oldest first; a file that a broken run left half written does not count."""
    path, fs = _path(spark, f"{folder.rstrip('/')}/{COMMITS}")
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if re.fullmatch(r"\d{10}\.json", name):
            lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
            stream = fs.open(status.getPath())
            try:
                text = lines.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                found.append(Commit(int(name[:10]), json.loads(text)["generation"]))
            except (ValueError, KeyError):
                continue
    return sorted(found, key=lambda c: c.number)


def _commit(spark: SparkSession, folder: str, number: int, generation: str) -> Commit:
    path, fs = _path(spark, f"{folder.rstrip('/')}/{COMMITS}/{number:010d}.json")
    try:
        stream = fs.create(path, False)
    except Exception as taken:
        raise RuntimeError(f"another run committed number {number} first") from taken
    try:
        stream.write(bytearray(json.dumps({"generation": generation}).encode()))
    finally:
        stream.close()
    return Commit(number, generation)


def committed_manifest(spark: SparkSession, folder: str, commit: Commit | None = None) -> DataFrame:
    """The manifest of ``commit`` (the last one if not given); without any, an empty one."""
    known = commits(spark, folder)
    commit = commit or (known[-1] if known else None)
    if commit is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/{MANIFESTS}/{commit.generation}")


def scan_generation(spark: SparkSession, folder: str, schema: T.StructType, commit: Commit | None = None) -> DataFrame:
    """Rows of a committed generation (the last one if not given), with ``segment_id``; without any, no rows.

    ``schema`` is that of the rows. Each segment is read from the folder it was last written to.
    """
    folder = folder.rstrip("/")
    manifest = committed_manifest(spark, folder, commit)
    columns = [f for f in schema.fields if f.name != SEGMENT]
    kind = T.StructType([*columns, T.StructField(SEGMENT, T.IntegerType())])
    # as many names as there are generations with a segment still in use
    written = [r.generation for r in manifest.select("generation").distinct().orderBy("generation").collect()]
    parts = []
    for generation in written:
        own = manifest.where(F.col("generation") == generation)
        rows = spark.read.schema(kind).parquet(f"{folder}/{DATA}/{generation}")
        parts.append(read_segments(rows, own, own.count()))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], kind)


def write_generation(
    df: DataFrame,
    folder: str,
    spec: PartitionSpec,
    table: str,
    segment_key: str,
    accept: Callable[[DataFrame], None] = lambda manifest: None,
) -> Commit:
    """Make the assigned rows the table's content: write the segments that changed, then the manifest, then the commit.

    A segment with the digest of its committed one is not written again; one without rows leaves the table. ``df`` is
    read for the digests and for the rows, so it should be a staged table. Counts of what was written are held
    against the digests' counts; a difference fails the run, as does an error that ``accept`` raises over the manifest,
    and a failed run leaves the table as it was.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    known = commits(spark, folder)
    before = committed_manifest(spark, folder, known[-1] if known else None)
    generation = f"{segment_key}-{secrets.token_hex(4)}"
    target = f"{folder}/{DATA}/{generation}"
    plan = segment_digests(df).join(before.select(SEGMENT, F.col("digest").alias("known"), F.col("generation").alias("held")), SEGMENT, "left")
    plan_path = f"{folder}/{MANIFESTS}/_{generation}"
    try:
        plan.write.parquet(plan_path)
        plan = spark.read.schema(plan.schema).parquet(plan_path)
        same = F.col("digest").eqNullSafe(F.col("known"))
        changed = plan.where(~same)
        wanted = F.broadcast(changed.select(F.col(SEGMENT).alias(WANTED)))
        number = changed.count()
        if number:
            rows = df if number == plan.count() else df.join(wanted, F.col(SEGMENT) == F.col(WANTED), "left_semi")
            write_segments(rows, target, spec)
            written = segment_manifest(spark, target, table, segment_key, spec.segment_count)
            fresh = changed.join(written.drop("record_count").join(written.select(SEGMENT, F.col("record_count").alias("found")), SEGMENT), SEGMENT)
            lost = fresh.where("found <> record_count").select(SEGMENT, "record_count", "found").take(1)
            if lost or fresh.count() != number:
                raise RuntimeError(f"the written segments differ from their rows: {lost}")
            parts = fresh.select(SEGMENT, F.lit(generation).alias("generation"), "record_count", "byte_size", "file_count", "digest")
        else:
            parts = spark.createDataFrame([], MANIFEST)
        kept = before.join(plan.where(same).select(SEGMENT), SEGMENT, "left_semi")
        manifest = parts.unionByName(kept.select(*MANIFEST.names)).select(*MANIFEST.names)
        manifest.coalesce(1).write.parquet(f"{folder}/{MANIFESTS}/{generation}")
        accept(spark.read.schema(MANIFEST).parquet(f"{folder}/{MANIFESTS}/{generation}"))
        return _commit(spark, folder, (known[-1].number if known else 0) + 1, generation)
    except Exception:
        for uri in (target, f"{folder}/{MANIFESTS}/{generation}"):
            _remove(spark, uri)
        raise
    finally:
        _remove(spark, plan_path)


def _remove(spark: SparkSession, uri: str) -> None:
    clean_target(spark, uri)
    path, fs = _path(spark, uri)
    fs.delete(path, True)


def changed_segments(spark: SparkSession, folder: str, commit: Commit | None = None) -> DataFrame:
    """Ids of the segments that the commit's run wrote itself."""
    known = commits(spark, folder)
    commit = commit or known[-1]
    return committed_manifest(spark, folder, commit).where(F.col("generation") == commit.generation).select(SEGMENT)


def expire_generations(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Forget all commits but the last ``keep``, and remove the data that no kept one needs, broken runs' included.

    Not while another run writes: its data has no commit yet.
    """
    folder, known = folder.rstrip("/"), commits(spark, folder)
    if keep < 1:
        raise ValueError("the last commit has to stay")
    stay = known[-keep:]
    needed = {r.generation for c in stay for r in committed_manifest(spark, folder, c).select("generation").distinct().collect()}
    gone = []
    for kind, names in ((COMMITS, {f"{c.number:010d}.json" for c in stay}), (MANIFESTS, {c.generation for c in stay}), (DATA, needed)):
        path, fs = _path(spark, f"{folder}/{kind}")
        for status in fs.listStatus(path) if fs.exists(path) else []:
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), True)
                gone.append(f"{kind}/{status.getPath().getName()}")
    return sorted(gone)


def generation_manifest(manifest: DataFrame, folder: str, table: str, segment_key: str, segments: int) -> DataFrame:
    """A committed manifest in the form of ``segment_manifest``: all segments, with names and locations."""
    segment, home = F.col(SEGMENT), F.concat(F.lit(f"{folder.rstrip('/')}/{DATA}/"), F.col("generation"))
    every = all_segments(manifest.sparkSession, segments).join(manifest, SEGMENT, "left")
    return every.select(
        SEGMENT,
        segment_name(table, segment_key, segment).alias("segment_name"),
        F.concat(home, F.lit(f"/{SEGMENT}="), segment.cast("string")).alias("segment_uri"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("record_count", "byte_size", "file_count")],
    )
