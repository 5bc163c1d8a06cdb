"""Line dedup, SimHash groups and components against brute force, and their odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

from segloom.llm.components import _with_minimum, connected_components
from segloom.llm.line_dedup import dedup_lines
from segloom.llm.simhash import (
    drop_near_duplicates,
    fingerprint,
    fingerprint_links,
    near_duplicates,
    plan_parts,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOCS)


def brute_lines(texts):
    holders = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("hot_holders", [1_000, 5])
def test_lines_against_brute_force(spark, monkeypatch, hot_holders):
    monkeypatch.setattr("segloom.llm.line_dedup.HOT_HOLDERS", hot_holders)
    rng = random.Random(1)
    pool = [f"{'Shared line number':<18} {k} É" for k in range(12)] + ["short", "", "  "]
    texts = ["\n".join(rng.choice(pool) + rng.choice(["", "  ", "\t", " x"]) for _ in range(rng.randrange(6))) for _ in range(60)]
    texts += [None, "", "\n", "SHARED LINE NUMBER 1 É\nShared line number 1 É"]
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in dedup_lines(docs(spark, texts)).collect()}
    assert found == brute_lines(texts)


def test_lines_of_odd_tables(spark):
    line = "a line that is long enough"
    df = spark.createDataFrame([(1, line, 7), (1, line, 7), (2, line, 8), (None, line, 9), (3, "x " * 200_000, 1)], "doc_id bigint, text string, n_dropped int")
    rows = dedup_lines(df)
    assert rows.columns == ["doc_id", "text", "n_lines", "n_dropped", "kept_text"]
    assert sorted((r.doc_id or 0, r.n_dropped) for r in rows.collect()) == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0)]
    assert dedup_lines(df.limit(0)).count() == 0


def hamming_groups(fps, distance):
    group = {f: f for f in fps}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
                group[root(a)] = root(b)
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("distance,crowded", [(4, 256), (4, 2), (3, 2)])
def test_links_have_all_components(spark, distance, crowded):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) - 2**63 for _ in range(300)}
    for _ in range(5):
        base = rng.getrandbits(64)
        for _ in range(60):
            near = base
            for bit in rng.sample(range(64), rng.randrange(6)):
                near ^= 1 << bit
            fps.add(near - 2**64 if near >> 63 else near)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    links = [(r.a, r.b) for r in fingerprint_links(df, distance, crowded).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= distance for a, b in links)
    want = hamming_groups(fps, distance)
    got = {f: f for f in fps}
    rows = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    got |= {r.node: r.component for r in rows}
    classes = lambda m: {frozenset(f for f in m if m[f] == g) for g in set(m.values())}
    assert classes(got) == classes(want)


def test_thresholds_follow_the_pigeonhole_principle():
    import numpy as np

    for n in (1e3, 1e6, 1e9):
        both = np.full((64, 64), n / 4)
        np.fill_diagonal(both, n / 2)
        parts = plan_parts(both, int(n), 4)
        assert sum(p.radius + 1 for p in parts) == 5
        assert len({b for p in parts for b in p.bits}) == sum(len(p.bits) for p in parts)


def test_components_of_chains_and_hubs(spark):
    chain = [(k, k + 1) for k in range(100)]
    hub = [(1000, 1000 + k) for k in range(1, 200)]
    rows = connected_components(spark.createDataFrame(chain + hub + hub + [(5, 5)], "a bigint, b bigint")).collect()
    assert len(rows) == 101 + 200 and {r.component for r in rows} == {0, 1000}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_hub_is_split_between_tasks(spark):
    """Half of all links are at one node; the minimum is joined back without a broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        links = spark.range(0, 400_000, 1, 8).selectExpr("IF(id % 2 = 0, 0L, id) AS node", "xxhash64(id) AS neighbour")
        # the sums keep the columns, which would else not be exchanged
        sums = [F.count(F.lit(1)).alias("n"), F.bit_xor("neighbour"), F.bit_xor("low")]
        tasks = _with_minimum(links).groupBy(F.spark_partition_id()).agg(*sums).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    sizes = sorted(r["n"] for r in tasks)
    assert sum(sizes) == 400_000
    assert sizes[-1] < 60_000  # of 200,000 at the hub


def test_near_duplicates_of_odd_tables(spark):
    long = " ".join(f"word{k}" for k in range(2000))
    texts = [None, "", " \n", long, long + " end", "one two", "ONE  two", "other words here"]
    rows = {r.doc_id: r for r in near_duplicates(docs(spark, texts)).withColumnRenamed("id", "doc_id").collect()}
    assert [rows[k].component_id for k in range(8)] == [0, 0, 0, 3, 3, 5, 5, 7]
    assert rows[0].fingerprint == "0" * 16 and len(rows[7].fingerprint) == 16
    assert int(rows[5].fingerprint, 16) == fingerprint("one two", 4) % 2**64
    assert near_duplicates(docs(spark, texts).limit(0)).count() == 0
    kept = drop_near_duplicates(docs(spark, texts + texts, [*range(8), *range(8)]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 7]
    no_ids = docs(spark, ["same text"] * 3 + ["another one"], [None, None, None, 4])
    assert [r.doc_id for r in drop_near_duplicates(no_ids).orderBy(F.col("doc_id").asc_nulls_first()).collect()] == [None, 4]


def test_fingerprint_by_definition():
    import xxhash

    words = "the quick brown fox jumps over THE lazy dog".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]), 42) for k in range(len(words) - 3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert fingerprint("The quick  brown\tfox jumps over the lazy DOG\n", 4) % 2**64 == want
