"""Near-duplicates of the pipeline against brute-force Jaccard."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from segloom.llm import similar
from segloom.llm.similar import drop_similar

VOCABULARY = [f"w{k}" for k in range(3000)]


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def survivors(texts):
    """Smallest index of each component of pairs with a Jaccard similarity of 0.8 or more."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(texts)), 2):
        union = len(sets[a] | sets[b])
        if not union or len(sets[a] & sets[b]) / union >= 0.8 - 1e-12:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [k for k in range(len(texts)) if find(k) == k]


def texts_of(seed):
    """Texts with copies around a similarity of 0.8, a crowd of near copies and a passage that many share."""
    rng = random.Random(seed)
    passage = rng.choices(VOCABULARY, k=40)
    out = []
    for k in range(60):
        base = rng.choices(VOCABULARY, k=rng.choice([3, 5, 6, 12, 60, 200, 500]))
        base = base + passage if k % 2 else base
        out.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            out.append(" ".join(copy).title() if rng.random() < 0.3 else " ".join(copy))
    crowd = rng.choices(VOCABULARY, k=150)
    for _ in range(60):
        copy = list(crowd)
        for _ in range(3):
            copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
        out.append(" ".join(copy))
    rng.shuffle(out)
    return [*out, "", None, " \n", out[0], out[1]]


@pytest.mark.parametrize("sample, common", [(1, 4), (8, 64)])
def test_stage_against_brute_force_jaccard(spark, monkeypatch, sample, common):
    monkeypatch.setattr(similar, "SAMPLE", sample)
    monkeypatch.setattr(similar, "COMMON", common)
    texts = texts_of(common)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    left = corpus_pipeline.unique_documents(spark, df, "")
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == survivors(texts)


def test_similar_rows_of_odd_tables(spark):
    rows = [(7, "a b"), (7, "a b"), (None, "A  b"), (3, "c d e f g h"), (None, None), (None, ""), (9, "a b c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = drop_similar(df).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [r.doc_id for r in left] == [None, 3, 7, 9]
    assert drop_similar(df.limit(0)).count() == 0


def test_long_texts_just_short_of_similar_are_not_all_verified(spark, monkeypatch):
    """200 texts of 3,000 words that share 2,600, a similarity of 0.76, and a few that are similar."""
    rng = random.Random(4)
    words = [f"v{k}" for k in range(50_000)]
    shared = rng.choices(words, k=2600)
    texts = [" ".join(shared + rng.choices(words, k=400)) for _ in range(200)]
    texts += [" ".join(t.split()[:2950] + rng.choices(words, k=50)) for t in texts[:10]]
    asked = []
    real = similar.verified

    def counting(pairs, *rest):
        asked.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(similar, "verified", counting)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert sorted(r.doc_id for r in drop_similar(df).collect()) == list(range(200))
    assert sum(asked) <= 3 * len(texts)


def test_fine_sketches_never_differ_more_than_the_sets():
    rng = random.Random(6)
    import numpy as np

    for n in (0, 1, 40, 300, 5000):
        one = {rng.randrange(2**64) for _ in range(n)}
        for m in (0, n // 30, n // 3, 2 * n):
            other = set(list(one)[m // 2 :]) | {rng.randrange(2**64) for _ in range(m)}
            sketches = [similar.fine_sketch(np.array(sorted(x), np.uint64)) for x in (one, other)]
            assert similar.apart(*sketches) <= len(one ^ other)
            assert similar.apart(*sketches) >= 0.6 * len(one ^ other) - 10


def test_similar_rows_with_clashing_columns_and_a_long_text(spark):
    long = " ".join(f"x{k}" for k in range(120_000))
    rows = [(1, long, 1, 2), (2, long + " end", 1, 2), (3, "short text of its own here", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node int, nth int")
    left = drop_similar(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_simhash_is_the_first_search(spark, monkeypatch):
    """Fingerprints within 4 bits are found, and each text is compared with one of them first and not again."""
    from segloom.llm.common import packed

    rng = random.Random(9)
    texts = []
    for _ in range(12):
        base = rng.choices(VOCABULARY, k=400)
        texts += [" ".join(base), " ".join([*base, "end"]), " ".join([*base[:-2], "other", "end"]), " ".join([*base[:200], *base])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = packed(df, "doc_id", "text").select("id", F.xxhash64("text").alias("text_hash"), "text")
    sets = similar.with_sets(rows, 5, 0.8).cache()
    near = {r.node: r.fp for r in sets.collect()}
    for text in texts[:8]:
        found = similar.shingle_set(text, 5)
        ones = [sum(int(h) >> b & 1 for h in found) for b in range(64)]
        want = sum(1 << b for b in range(64) if 2 * ones[b] > len(found))
        assert want - (want >> 63 << 64) in near.values()

    def groups(pairs):
        root = {n: n for n in near}
        for a, b in pairs:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)

        def top(n):
            return n if root[n] == n else top(root[n])

        return {n: top(n) for n in near}

    close = [(a, b) for a, b in combinations(near, 2) if ((near[a] ^ near[b]) & (2**64 - 1)).bit_count() <= 4]
    pairs = [tuple(r) for r in similar.fingerprint_pairs(sets).collect()]
    assert len(close) >= 12 and groups(pairs) == groups(close)
    asked = []
    real = similar.verified

    def listing(pairs, *rest):
        asked.append({tuple(r) for r in pairs.collect()})
        return real(pairs, *rest)

    monkeypatch.setattr(similar, "verified", listing)
    assert sorted(r.doc_id for r in drop_similar(df).collect()) == survivors(texts)
    assert asked[0] <= set(pairs) and len(asked[0]) == len({b for _, b in asked[0]}) >= 12
    assert not any(asked[0] & later for later in asked[1:])
