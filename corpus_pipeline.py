"""From raw documents to packed training sequences, as stages over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm.common import held_out, remove, scratch
from segloom.llm.decontaminate import drop_contaminated
from segloom.llm.line_dedup import dedup_lines
from segloom.llm.packing import pack_documents
from segloom.llm.quality import fit_quality, quality_score
from segloom.llm.similar import drop_similar
from segloom.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document stays if its calibrated chance of being good is at least this.
QUALITY = 0.7


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on labels outside the held-out fold.

    Without a labelled document nothing can be told apart, and all documents stay. Repeated rows stay or go together;
    null and empty texts are scored like any other, rows without id too; an empty table gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id"), 4, 2))
    model = fit_quality(docs, labels)
    return docs.where(quality_score(model, F.col("text")) >= QUALITY) if model.fitted else docs


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that three or more share; ``n_chars`` follows the text.

    Every document stays, if need be with an empty text, which null becomes; rows with one id count as one document; an
    empty table gives an empty one.
    """
    kept = dedup_lines(docs)
    kept = kept.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")})
    return kept.select(*docs.columns)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles with a similarity of 0.8 or more connect.

    SimHash fingerprints are searched first; what they leave apart is searched by shingles, and texts decide.
    It is the one with the smallest id, a row without id only if none has one. Null, empty and blank texts are one
    group, repeated rows another; an empty table gives an empty one.
    """
    return drop_similar(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; repeated rows stay or go together; an empty table or benchmark changes nothing.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4,096 ids, and the ids as bytes.

    Null and empty texts are a piece with the end id alone; repeated rows are packed once each; an empty table
    gives an empty one.
    """
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, vocabulary).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", unique_lines),
    ("simhash near-dedup", unique_documents),
    ("benchmark decontamination", unseen_documents),
    ("best-fit packing", packed_sequences),
]

#: SQL has neither the scores nor the fingerprints; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next.

    What a stage wrote for itself is removed when its result is written, the result when the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
