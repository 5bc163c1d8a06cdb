"""The registered queries of the package, and the pipeline, over the smallest tables."""

import zlib

import numpy as np
import pytest
from compare import connect, plain

import __spark_entry__ as contract
import corpus_pipeline
from segloom.llm.oracle import ORACLE
from segloom.llm.queries import QUERIES
from segloom.llm.simhash import fingerprint

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_registry():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    rows = QUERIES[name](spark, SMALL)
    result = connect(SMALL).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(rows.columns)
    want = sorted(tuple(plain(v) for v in r) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in rows.collect()) == want


@pytest.mark.parametrize("name,modulus,remainder", [("op1_toxicity", 5, 0), ("op9_quality", 4, 2)])
def test_scores_cover_all_documents(spark, documents, name, modulus, remainder):
    rows = QUERIES[name](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_near_duplicates_against_brute_force(spark, documents):
    prints = {d: fingerprint(t, 4) % 2**64 for d, t in documents.items()}
    ids, group = sorted(prints), {d: d for d in prints}
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    rows = QUERIES["op10_simhash"](spark, SMALL).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {d: (prints[d], group[d]) for d in ids}


def test_pipeline_stage_by_stage(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    last = {r.doc_id: r.text for r in docs.collect()}
    assert set(last) <= set(documents)
    prints = [fingerprint(t, 4) for t in last.values()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") > 4 for i, a in enumerate(prints) for b in prints[:i])
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not [d for d, t in last.items() if any(i in t for i in items)]
    rows = corpus_pipeline.run(spark, SMALL).toPandas()
    assert set(rows.doc_id) == set(last)
    assert np.all(rows.groupby("sequence_id").length.sum() <= 4096)
