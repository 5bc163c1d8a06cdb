"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from segloom.llm import periodic
from segloom.llm.periodic import find_runs, periodic_runs, tiles
from segloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_force(words, least=12):
    """(start, length, period) of all runs, by start, then period."""
    found, codes = [], np.unique(words, return_inverse=True)[1]
    for period in range(1, len(words) // 2 + 1):
        if np.count_nonzero(codes[:-period] == codes[period:]) < min(period, least - 1):
            continue
        k = 0
        while k < len(words) - period:
            first = k
            while k < len(words) - period and words[k] == words[k + period]:
                k += 1
            stretch = words[first : k + period]
            if len(stretch) >= max(least, 2 * period) and not any(stretch[d:] == stretch[:-d] for d in range(1, period)):
                found.append((first, len(stretch), period))
            k += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def sequences(seed):
    rng = random.Random(seed)
    fibonacci, longer = [1], [1, 0]
    while len(longer) < 300:
        fibonacci, longer = longer, longer + fibonacci
    out = [[], [1], [1] * 11, [1] * 12, [1] * 400, longer[:300], [1, 2, 3, 4, 5] * 80]
    for _ in range(120):
        unit = [rng.randrange(40) for _ in range(rng.randrange(1, 70))]
        words = (unit * 200)[: rng.choice([20, 60, 150, 400])]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = 99
        out.append(words if rng.random() < 0.6 else [rng.randrange(2) for _ in words])
    return out


@pytest.mark.parametrize("least", [2, 4, 12])
def test_all_runs_of_many_tiles_at_once(least):
    docs = sequences(least)
    codes = np.array([w for d in docs for w in d], np.int64)
    of, first, last, period = find_runs(codes, np.cumsum([0, *map(len, docs)]), least=least)
    got = sorted(zip(of.tolist(), first.tolist(), (last - first).tolist(), period.tolist()))
    assert got == sorted((k, *r) for k, d in enumerate(docs) for r in brute_force(d, least))


@pytest.mark.parametrize("size", [64, 128, 1024])
def test_tiles_share_what_a_run_needs(size):
    for n in (10, 63, 64, 65, 200, 1000, 5000):
        held = {}
        for low, high, start, end in tiles(n, 12, size):
            for k in range(low, high):
                held.setdefault(k, []).append((start, end))
        for period in (1, 2, 7, 8, 9, 31, 32, n // 2):
            need = max(12, 2 * period)
            for start in range(0, n - need + 1, 3):
                assert any(a <= start and start + need <= b for a, b in held[period.bit_length() - 1])


@pytest.mark.parametrize("tile", [64, 256, periodic.TILE])
def test_documents_in_tiles(spark, tile):
    texts = [" ".join(f"w{k}" for k in d) for d in sequences(5)[:60]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for row in periodic_runs(df, tile=tile).collect():
        words = texts[row.doc_id].split()
        runs = brute_force(words)
        assert [(r.start, r.length, r.period) for r in row.runs] == runs
        assert (row.n_words, row.n_runs, row.collapsed_text) == (len(words), len(runs), collapsed(words, runs))


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row in rows:
        words = (texts[row.doc_id] or "").encode().split()
        words, n, h = [w.decode() for w in words], len(words), zlib.crc32(str(row.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_force(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == want
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert row.collapsed_sha256 == sha(collapsed(words, runs))


def test_odd_tables(spark):
    long = "a b c " * 100_000
    rows = [(1, None, 7), (2, "", 7), (3, " \t\n ", 7), (None, "x " * 12, 7), (4, "x " * 12, 7), (4, "x " * 12, 7), (5, long, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in periodic_runs(df).collect()), key=str)
    one = [(0, 12, 1)]
    assert got == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 12, one, "x"), (4, 12, one, "x"), (4, 12, one, "x"), (5, 300_000, [(0, 300_000, 3)], "a b c")],
        key=str,
    )
    out = periodic_runs(df.limit(0))
    assert out.count() == 0 and out.columns == ["doc_id", "n_words", "n_runs", "runs", "collapsed_text"]
    assert periodic_runs(df.select("text")).count() == 7
    clashing = df.withColumnsRenamed({"doc_id": "uid", "runs": "words"}).selectExpr("*", "uid AS row")
    assert periodic_runs(clashing).columns == ["uid", "words", "row", "n_words", "n_runs", "runs", "collapsed_text"]
