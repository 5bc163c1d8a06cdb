"""Phrases against brute force."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from segloom.llm import phrases
from segloom.llm.phrases import find_phrases, phrase_counts, prefix_counts


def pieces_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def brute_counts(rows, longest):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return counts, totals


def brute_force(rows, longest, least, top, contained=100):
    counts, totals = brute_counts(rows, longest)
    often = {key: f for key, f in counts.items() if f >= least}
    found = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            o == lang and f * 100 >= contained * a and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))
            for (o, w), f in often.items()
        )
        if not inside:
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def texts(seed):
    """Two languages, common pairs and passages, odd characters, and marks with and without blanks."""
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "größe", "a\x01b", "\x00", "x y", "é", "日本", "-", "a'b"] + [f"w{k}" for k in range(40)]
    passage = rng.choices(words, k=9)
    out = []
    for _ in range(300):
        body = rng.choices(words, weights=[20, 5, 15, 10] + [2] * (len(words) - 4), k=rng.randrange(0, 60))
        at = rng.randrange(len(body) + 1)
        body[at:at] = passage if rng.random() < 0.4 else ["of", "the"] * rng.randrange(3)
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for w in body)
        out.append((rng.choice(["en", "en", "de", None, ""]), text))
    return [*out, ("en", None), ("en", ""), ("fr", " .. \n"), *out[:20]]


@pytest.mark.parametrize("longest, least, top, slots, contained", [(5, 10, 2000, 1 << 22, 100), (5, 5, 7, 1 << 16, 80), (3, 2, 50, 1 << 16, 100)])
def test_against_brute_force(spark, monkeypatch, longest, least, top, slots, contained):
    monkeypatch.setattr(phrases, "CHUNK", 2_000)
    monkeypatch.setattr(phrases, "ROWS_PER_TASK", 400)
    rows = texts(least)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = find_phrases(df, longest, least, top, contained, slots=slots)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows, longest, least, top, contained)


def test_counts_of_parts_at_range_edges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "ROWS_PER_TASK", 20)
    rows = texts(4)
    df = spark.createDataFrame(rows, "lang string, text string")
    found, totals = phrase_counts(df, 4, 3)
    counts, words = brute_counts(rows, 4)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found.collect()} == {k: f for k, f in counts.items() if f >= 3}
    assert {r.lang: r.n for r in totals.collect()} == dict(words) | {"fr": 0}


def test_prefixes_of_a_stream_in_any_batches():
    rng = random.Random(3)
    rows = sorted(Counter(tuple(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(300)).items())
    want = Counter()
    for words, n in rows:
        for k in range(1, len(words) + 1):
            want[" ".join(words[:k])] += n
    for size in (1, 2, 7, 1000):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array(["x"] * len(part)), pa.array(["".join(w + " " for w in words) for words, _ in part]), pa.array([n for _, n in part], pa.int64())],
                ["lang", "window", "n"],
            )
            for part in (rows[k : k + size] for k in range(0, len(rows), size))
        ]
        got = Counter()
        for batch in prefix_counts(iter(batches), 4, 1):
            for row in batch.to_pylist():
                got[row["phrase"]] += row["f"]
                assert row["words"] == len(row["phrase"].split(" "))
        assert got == want
        often = {r["phrase"] for b in prefix_counts(iter(batches), 4, 20) for r in b.to_pylist()}
        assert {p for p, f in want.items() if f >= 20} <= often
        assert len(often - {p for p, f in want.items() if f >= 20}) <= 8


def test_odd_tables(spark):
    schema = "doc_id bigint, lang string, text string, rank int, phrase string"
    assert find_phrases(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, "a b " * 30_000, 1, "x"), (None, None, "a b " * 30_000, 1, "x"), (1, "en", None, None, None)]
    got = find_phrases(spark.createDataFrame(rows, schema), longest=2).collect()
    # a b 60,000 times, b a 59,998 times, of 120,000 words
    assert [tuple(r) for r in got] == [("und", 1, "a b", 60_000, 60_000, 60_000, 120_000, 2000), ("und", 2, "b a", 59_998, 60_000, 60_000, 120_000, 1999)]
