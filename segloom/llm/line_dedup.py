"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import ASCII_LOWER, ASCII_SPACE, ASCII_UPPER, packed, staged, unpacked

#: Keys that are sent to every executor, at most; they take some 30 bytes each.
HOT_KEYS = 10_000
#: Holders that a key has at least to be one of them.
HOT_HOLDERS = 1_000


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), ASCII_UPPER, ASCII_LOWER)


def hashes(key: Column) -> list[Column]:
    """128 bits of a key, so that distinct keys do not meet at any corpus size in sight."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Drops repeated lines, all but those in the largest document id that holds them.

    Texts are split at ``\\n``. A line whose key (see ``line_key``) has at least ``min_chars``
    code points and is found in at least ``min_docs`` documents stays only in the documents
    with the largest id among its holders. Returns all columns of ``docs`` plus ``n_lines``
    (before dropping), ``n_dropped`` and ``kept_text``.

    Lines are exploded and hashed; documents per hash are counted after a partial count on the
    map side, each document once per key. The lines that go are gathered by document as
    positions, and a text is put together again from the positions that stay. Texts cross the
    network once, hashes twice. Keys with the most holders are broadcast, and their lines are spread over
    all tasks instead of meeting in one: a key is among them if it has over ``HOT_HOLDERS`` holders
    and over a ``HOT_KEYS``-th of all keys' holders, so there are fewer than ``HOT_KEYS`` of them.

    Defined cases: a null or empty text is one empty line and stays as the empty text; each
    row counts as one document, so repeated rows count repeatedly and are treated alike; a row
    without id loses a repeated line if any holder has an id; rows whose holders all lack ids
    keep it; an empty table gives an empty table.
    """
    rows = packed(docs, id_column, text_column).withColumns(
        {"lines": F.split("text", "\n", -1), "text_hash": F.xxhash64("text")}
    )
    keys = F.transform("lines", line_key)
    long_enough = F.array_distinct(F.filter(keys, lambda k: F.char_length(k) >= min_chars))
    repeated = (
        rows.select("id", F.explode(long_enough).alias("key"))
        .select("id", *hashes(F.col("key")))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("holders"), F.max("id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
    )
    repeated = staged(repeated, "repeated-lines")
    often = max(HOT_HOLDERS, (repeated.agg(F.sum("holders")).first()[0] or 0) // HOT_KEYS)
    hot = repeated.where(F.col("holders") > often).select("h1", "h2", F.struct("keeper").alias("hot"))
    lines = (
        rows.select("id", "text_hash", F.posexplode(keys).alias("at", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "at", *hashes(F.col("key")))
        .join(F.broadcast(hot), ["h1", "h2"], "left")
        .withColumn("h1", F.when(F.col("hot").isNull(), F.col("h1")).otherwise(F.xxhash64("id", "text_hash", "at")))
    )
    found = lines.join(repeated.select("h1", "h2", F.struct("keeper").alias("other")), ["h1", "h2"], "left")
    keeper = F.coalesce("hot", "other")
    drops = (
        found.where(keeper.isNotNull())
        .select("id", "text_hash", "at", keeper["keeper"].alias("keeper"))
        .where(F.coalesce(F.col("id") < F.col("keeper"), F.col("keeper").isNotNull()))
        .groupBy(F.col("id").alias("drop_id"), F.col("text_hash").alias("drop_hash"))
        .agg(F.collect_set("at").alias("dropped"))
        .hint("shuffle_hash")
    )
    same = F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash"))
    last = F.size("lines") - 1
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), last), "dropped"),
        lambda i: F.element_at("lines", i + 1),
    )
    joined = rows.select("row", "id", "text", "text_hash").join(drops, same, "left")
    result = joined.withColumn("lines", F.split("text", "\n", -1)).select(
        "row",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("text"))
        .otherwise(F.array_join(kept, "\n"))
        .alias("kept_text"),
    )
    return unpacked(result, "n_lines", "n_dropped", "kept_text")
