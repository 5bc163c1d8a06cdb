"""Removal of repeated passages against brute force."""

import random

import numpy as np
import pytest

from segloom.llm import passages
from segloom.llm.passages import Known, Occurrences, drop_repeated_passages, window_digests


def brute_force(rows, window):
    """(id, words, removed, kept text) of each row."""
    split = [(k, [w.decode() for w in (t or "").encode().split()]) for k, t in rows]
    first = {}
    for k, words in split:
        for i in range(len(words) - window + 1):
            if k is not None:
                body = tuple(words[i : i + window])
                first[body] = min(first.get(body, k), k)
    out = []
    for k, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if k is not None and first[tuple(words[i : i + window])] < k:
                gone.update(range(i, i + window))
        out.append((k, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def documents(seed, window):
    """Shared passages at odd places, copies of copies, few distinct words, repeated rows and rows without id."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    shared = [rng.choices(words, k=rng.randrange(window - 1, 4 * window)) for _ in range(12)]
    out = []
    for k in range(260):
        body = rng.choices(words, k=rng.randrange(0, 5 * window))
        if k % 5 == 4:
            body = rng.choices(["x", "y"], k=len(body))
        for _ in range(rng.randrange(4)):
            part = rng.choice(shared)
            cut = rng.randrange(len(part))
            at = rng.randrange(len(body) + 1)
            body[at:at] = part[cut:] if rng.random() < 0.4 else part
        if out and rng.random() < 0.25:
            body = rng.choice(out)[1].split()
            body = body[rng.randrange(1 + len(body) // 4) :]
        out.append((rng.randrange(10_000) if k % 9 else k, rng.choice([" ", "\n", " \t"]).join(body)))
    copies = [(20_000 + k, out[7][1] + " " + " ".join(rng.choices(words, k=3))) for k in range(60)]
    return [*out, *copies, *out[:15], (None, out[3][1]), (None, None), (5, None), (6, ""), (-4, out[8][1])]


@pytest.mark.parametrize("window, phrase, few", [(8, 3, True), (8, 8, False), (50, 10, False), (5, 1, True)])
def test_against_brute_force(spark, monkeypatch, window, phrase, few):
    if few:  # many shards, several tasks a shard, several parts of a shard's windows, no broadcast
        for name, size in {"PHRASES": 20, "BLOCKS": 30, "WINDOWS": 40, "BROADCAST_ROWS": 0}.items():
            monkeypatch.setattr(passages, name, size)
    rows = documents(window, window)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = drop_repeated_passages(df, window, phrase)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows, window)


def test_a_hot_passage_and_a_long_text(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"a{k} b{k} {passage} c{k}") for k in range(3_000)]
    rows.append((9_000, " ".join(f"l{k}" for k in range(300_000)) + " " + passage))
    got = {r.doc_id: r for r in drop_repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].n_removed == 0 and got[0].kept_text == rows[0][1]
    assert all(got[k].kept_text == f"a{k} b{k} c{k}" for k in range(1, 3_000))
    assert (got[9_000].n_words, got[9_000].n_removed) == (300_060, 60)


def test_odd_tables(spark):
    schema = "doc_id bigint, text string, id string, row int, gaps int, n_words int"
    df = spark.createDataFrame([(1, "a " * 60, "k", None, 2, 3), (2, "a " * 70, None, 1, None, 3)], schema)
    got = drop_repeated_passages(df)
    assert got.columns == ["doc_id", "id", "row", "gaps", "n_words", "n_removed", "kept_text"]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.id) for r in got.collect()) == [(1, 60, 0, "k"), (2, 70, 70, None)]
    assert drop_repeated_passages(df.limit(0)).count() == 0


def test_places_of_phrases():
    search = Occurrences()
    for phrase in ("a b", "b a", "b", "ab c", "ü a"):
        search.add(phrase)
    text = "a b a bb ab c ü a b"
    assert search.places(text, np.array([len(w) for w in text.split(" ")])) == {0, 1, 4, 6, 7, 8}
    assert Occurrences().places("a b", np.array([1, 1])) == set()


@pytest.mark.parametrize("window", [1, 2, 5, 8, 50])
def test_digests_of_windows(window):
    rng = random.Random(window)
    codes = np.array([rng.randrange(3) for _ in range(400)] * 2)
    hashes = np.array([rng.randrange(2**64) for _ in range(3)], np.uint64)
    one, two = window_digests(codes, hashes, window)
    places = range(len(codes) - window + 1)
    bodies = [tuple(codes[k : k + window]) for k in places]
    for digest in (one, two):
        assert len({(b, digest[k]) for k, b in zip(places, bodies)}) == len(set(bodies)) == len({digest[k] for k in places})


def test_known_windows_with_equal_first_digests():
    known = Known()
    known.add(np.array([5, 7, 7]), np.array([1, 2, 3]), 40)
    known.add(np.array([7]), np.array([4]), 30)
    found = known.smallest(np.array([7, 5, 7, 9, 7, 7]), np.array([4, 1, 3, 1, 2, 9]), np.full(6, 99))
    assert found.tolist() == [30, 40, 40, 99, 40, 99]
    assert Known().smallest(np.array([1]), np.array([1]), np.array([3])).tolist() == [3]
