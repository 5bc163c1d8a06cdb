"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.llm.common import held_out
from segloom.llm.decontaminate import find_contamination
from segloom.llm.fingerprints import fingerprint_documents
from segloom.llm.language import identify_languages
from segloom.llm.line_dedup import dedup_lines
from segloom.llm.packing import pack_documents
from segloom.llm.passages import drop_repeated_passages
from segloom.llm.periodic import periodic_runs
from segloom.llm.phrases import find_phrases
from segloom.llm.quality import fit_quality, quality_score
from segloom.llm.rans import read_token_files, write_token_files
from segloom.llm.simhash import near_duplicates
from segloom.llm.token_count import count_tokens
from segloom.llm.toxicity import fit_toxicity, score_toxicity
from segloom.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    return spark.read.options(**options).parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    index = fit_toxicity(docs, table(spark, sf_dir, "labels").where(~apart))
    return score_toxicity(docs, index).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    # vectored reads keep a copy of each column chunk beside the heap, in every thread that reads
    docs = table(spark, sf_dir, "documents", **{"parquet.hadoop.vectored.io.enabled": "false"})
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id").drop("text_hash")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary, with_ids=False).withColumnRenamed("id", "doc_id")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "page_id")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path, with_ids=False).withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, apart = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 4, 2)
    model = fit_quality(docs, table(spark, sf_dir, "labels").where(~apart))
    scored = docs.select("doc_id", apart.alias("held_out"), quality_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Of one text in ten (by its id's checksum) the words from a certain one on repeat with a certain period."""
    return docs.selectExpr(
        "doc_id",
        r"""
        CASE WHEN crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)) % 10 = 0 THEN
            transform(array(named_struct(
                'words', filter(split(coalesce(text, ''), '[ \\x09-\\x0D]+'), w -> w <> ''),
                'g', crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)) div 10)),
            x -> CASE WHEN size(x.words) = 0 THEN '' ELSE
                transform(array(named_struct('a', cast(x.g % size(x.words) AS int), 'f', 3 + x.g % 8)),
                y -> transform(array(cast(1 + (size(x.words) - y.a) div y.f AS int)),
                    p -> array_join(transform(sequence(0, size(x.words) - 1),
                        i -> x.words[CASE WHEN i < y.a THEN i ELSE y.a + (i - y.a) % p END]), ' '))[0])[0] END)[0]
        ELSE text END AS text
        """,
    )


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("top", longest).select(
        "doc_id",
        "n_runs",
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_phrases(table(spark, sf_dir, "documents"))


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_count": op5_token_count,
    "op6_packing": op6_packing,
    "op7_language": op7_language,
    "op8_token_files": op8_token_files,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_periodic": op11_periodic,
    "op12_phrases": op12_phrases,
    "op13_passages": op13_passages,
}
