"""Stages of the pipeline on tables that leave them nothing to learn from."""

import pytest

import corpus_pipeline


@pytest.mark.parametrize("ids", [[], [-1, -2, -3, -4, -5]])
def test_quality_stage_without_usable_labels_keeps_all(spark, tmp_path, ids):
    labels = spark.createDataFrame([(k, 1, 0) for k in ids], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(k, f"a clean text {k}") for k in range(9)], "doc_id bigint, text string")
    assert corpus_pipeline.good_documents(spark, docs, str(tmp_path)).count() == 9


def test_run_over_nulls_copies_a_long_text_and_an_empty_table(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    item = "which river runs through the old town of the seven bridges and how long is it"
    long = " ".join(f"word{k}" for k in range(60_000))
    texts = [None, "", long, long + " end", f"before it {item} after it", "a clean text about nothing much", "a clean text about nothing much", None]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/some/benchmark.parquet")
    spark.createDataFrame([(-1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/some/labels.parquet")
    docs = spark.createDataFrame([(k or None, t, "en", None, len(t or "")) for k, t in enumerate(texts)], schema)
    docs.write.parquet(f"{tmp_path}/some/documents.parquet")
    rows = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert {r.doc_id for r in rows} == {1, 2, 5}
    assert sum(r.length for r in rows if r.doc_id == 2) > 60_000
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/some/{name}.parquet").write.parquet(f"{tmp_path}/none/{name}.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
