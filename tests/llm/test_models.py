"""Scores, fingerprints, decontamination and languages: brute force, planted cases and odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from segloom.llm import language, quality, toxicity
from segloom.llm.calibrate import isotonic
from segloom.llm.decontaminate import drop_contaminated, find_contamination
from segloom.llm.fingerprints import (
    ENTROPY_BINS,
    WINDOW,
    digest_of,
    digests,
    edit,
    entropy_bins,
    fingerprint_documents,
    likeness,
    window_hashes,
)
from segloom.llm.language import identify_languages
from segloom.llm.quality import fit_quality, quality_score
from segloom.llm.queries import QUERIES
from segloom.llm.toxicity import ExampleIndex, fit_toxicity, score_toxicity, term_counts

RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choice("abcdeilnorst") for _ in range(RNG.randrange(2, 9))) for _ in range(400)]


def prose(rng, words):
    return " ".join(rng.choice(VOCABULARY) for _ in range(words))


def labelled(spark, make, n=400):
    rng = random.Random(n)
    rows = [(k, make(rng, k % 4 == 0), int(k % 4 == 0)) for k in range(n)]
    docs = spark.createDataFrame([(k, t, 0.5) for k, t, _ in rows], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows] + [(None, 1), (10**9, 0)], "doc_id bigint, label int")
    return docs, labels, {k: y for k, _, y in rows}


def test_quality_on_held_out_rows(spark):
    def make(rng, good):
        text = prose(rng, rng.randrange(30, 200))
        return text + "." if good else text.replace(" ", rng.choice([" | ", "%% ", "!! "]))

    docs, labels, truth = labelled(spark, make)
    model = fit_quality(docs, labels.where("doc_id % 3 <> 0"), "label")
    rows = docs.select("doc_id", quality_score(model, F.col("text")).alias("s")).collect()
    right = [(r.s >= 0.5) == truth[r.doc_id] for r in rows if r.doc_id % 3 == 0]
    assert np.mean(right) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 500_000), (3, "x" * 500_000)], "doc_id int, text string")
    scores = [r.s for r in odd.select(quality_score(model, F.col("text")).alias("s")).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[2] == scores[3]
    untrained = fit_quality(docs.limit(0), labels, "label")
    assert {r.s for r in docs.select(quality_score(untrained, F.col("text")).alias("s")).limit(9).collect()} == {0.5}


def test_isotonic_pools():
    knots, values = isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 2, 1, 4]), np.full(4, 4.0))
    assert list(knots) == [0, 1.5, 3] and np.all(np.diff(values) > 0)
    assert isotonic(np.zeros(0), np.zeros(0), np.zeros(0))[1].tolist() == [0.5]


def test_toxicity_on_held_out_rows(spark):
    bad = ["nitwit", "numskull", "blockhead"]

    def make(rng, toxic):
        words = prose(rng, rng.randrange(20, 120)).split()
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "s", "ery"]))
        return " ".join(words)

    docs, labels, truth = labelled(spark, make)
    index = fit_toxicity(docs, labels.where("doc_id % 3 <> 0"), "label")
    rows = score_toxicity(docs, index).collect()
    assert np.mean([(r.score >= 0.5) == truth[r.id] for r in rows if r.id % 3 == 0]) > 0.97
    assert all(0 <= r.score <= 1 and len(r.evidence) <= 3 for r in rows)
    odd = spark.createDataFrame([(None, None), (2, ""), (3, "a " * 200_000)], "doc_id bigint, text string")
    assert len(score_toxicity(odd, index).collect()) == 3
    empty = fit_toxicity(docs, labels.limit(0), "label")
    assert {r.score for r in score_toxicity(docs.limit(5), empty).collect()} == {0.5}


def build(rows):
    """An index of (id, label, term counts)."""
    terms = sorted({t for _, _, c in rows for t in c})
    entries = [(k, terms.index(t), n) for k, (_, _, c) in enumerate(rows) for t, n in c.items()]
    example, term, count = (np.array(x, np.int64) for x in zip(*entries))
    return ExampleIndex.build(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), terms, example, term, count)


def brute_weights(rows):
    """Weight factor of each term: inverse document frequency times evidence."""
    held = [r for r in rows if r[2]]
    n = [sum(y == k for _, y, _ in held) for k in (0, 1)]
    factors = {}
    for t in {t for _, _, c in held for t in c}:
        seen = [sum(y == k and t in c for _, y, c in held) for k in (0, 1)]
        rate, total = sum(seen) / len(held), 0.0
        for k in (0, 1):
            for have, expected in ((seen[k], rate * n[k]), (n[k] - seen[k], (1 - rate) * n[k])):
                total += have * math.log(have / expected) if have else 0.0
        factors[t] = (math.log((1 + len(held)) / (1 + sum(seen))) + 1) * (max(2 * total, 0.0) + 1e-3)
    return factors


def brute_cosines(rows, factors, counts):
    def unit(c):
        v = {t: (1 + math.log(n)) * factors[t] for t, n in c.items() if t in factors}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if v else {}

    query = unit(counts)
    return [sum(query.get(t, 0.0) * x for t, x in unit(c).items()) for _, _, c in rows]


def brute_vote(rows, cosines, k=15, leave=None):
    """All votes that the examples' order among equals allows."""
    held = [r for r in rows if r[2]]
    base = sum(y for _, y, _ in held) / len(held)
    ranked = sorted(((c, y) for i, (c, (_, y, _)) in enumerate(zip(cosines, rows)) if i != leave and c > 1e-12), reverse=True)
    if not ranked:
        return None
    floor = ranked[: k][-1][0]
    sure = [(c, y) for c, y in ranked if c > floor + 1e-9]
    equal = [y for c, y in ranked if abs(c - floor) <= 1e-9]
    out = []
    take = min(k, len(ranked)) - len(sure)
    for toxic in range(len(equal) + 1):
        if toxic > sum(equal) or take - toxic > len(equal) - sum(equal) or toxic > take:
            continue
        weigh = lambda c: 1 / (0.05 + 1 - min(c, 1.0))
        total = sum(weigh(c) for c, _ in sure) + take * weigh(floor)
        out.append((sum(weigh(c) * y for c, y in sure) + toxic * weigh(floor) + base) / (total + 1))
    return out


@pytest.mark.parametrize("block, first", [(256, 3), (16, 1), (4, 2)])
def test_nearest_examples_against_brute_force(monkeypatch, block, first):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "FIRST", first)
    rng = random.Random(8)
    rows = [(k, k % 2, dict(Counter(rng.choices(VOCABULARY[: 20 + 40 * (k % 2)], k=rng.randrange(0, 12))))) for k in range(500)]
    index, factors = build(rows), brute_weights(rows)
    for _ in range(40):
        counts = Counter(rng.choices(VOCABULARY[:80], k=6))
        places, scores = index.nearest(*index.vector(counts), k=10)
        brute = brute_cosines(rows, factors, counts)
        assert np.allclose(scores, sorted((c for c in brute if c > 0), reverse=True)[:10])
        assert np.allclose([brute[index.ids[p]] for p in places], scores)
    at = 17
    places, scores = index.nearest(*index.vectors()[at], leave=at)
    assert at not in places and np.isclose(index.nearest(*index.vectors()[at])[1][0], 1)


def test_whole_scores_against_brute_force(spark):
    """Terms, votes, calibration and scores of the smallest tables."""
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    apart = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    rows = [(k, labels[k], term_counts(texts[k])) for k in sorted(labels) if k in texts and not apart(k)]
    factors = brute_weights(rows)
    near = [brute_vote(rows, brute_cosines(rows, factors, c), leave=i) for i, (_, _, c) in enumerate(rows)]
    votes = {}
    for (_, y, c), vote in zip(rows, near):
        if c:
            assert vote is None or len(vote) == 1  # no ties that matter in these tables
            cell = votes.setdefault(round(0.5 if vote is None else vote[0], 3), [0, 0])
            cell[0] += y
            cell[1] += 1
    x = sorted(votes)
    knots = isotonic(np.array(x), *(np.array([float(votes[v][k]) for v in x]) for k in (0, 1)))
    got = QUERIES["op1_toxicity"](spark, folder).collect()
    for row in got:
        vote = brute_vote(rows, brute_cosines(rows, factors, term_counts(texts[row.doc_id])))
        if vote is not None:
            assert min(abs(row.score - (0.98 * np.interp(v, *knots) + 0.02 * v)) for v in vote) < 1e-6
    assert len({round(r.score, 9) for r in got}) > len(got) / 2
    assert sum(len(r.evidence) > 0 for r in got) > 0.95 * len(got)


def test_terms_of_a_text():
    assert term_counts("Loweient, lowe 12 LOWE") == {"loweient": 1, "lowe": 2}


def test_window_entropy_against_brute_force():
    rng = np.random.default_rng(3)
    octets = np.concatenate([rng.integers(97, 110, 300), np.full(80, 97), rng.integers(0, 256, 100)]).astype(np.uint8)
    for at, found in enumerate(entropy_bins(octets).tolist()):
        share = np.bincount(octets[at : at + WINDOW]) / WINDOW
        bits = -sum(p * math.log2(p) for p in share if p)
        assert abs(found - bits / math.log2(WINDOW) * (ENTROPY_BINS - 1)) <= 1.001
    assert len(entropy_bins(octets[: WINDOW - 1])) == 0


def brute_features(text, rank):
    """Places of the windows that are selected."""
    bins = entropy_bins(np.frombuffer(text, np.uint8)).tolist()
    if not bins:
        return [0] if text else []
    if len(bins) < WINDOW:
        return [min(range(len(bins)), key=lambda k: (rank[bins[k]], k))]
    popular = Counter(min(range(s, s + WINDOW), key=lambda k: (rank[bins[k]], k)) for s in range(len(bins) - WINDOW + 1))
    least = min(8, max(popular.values()))
    return sorted(k for k, n in popular.items() if n >= least)


def odd_bytes():
    rng = random.Random(12)
    plain = [prose(rng, n).encode() for n in (1, 3, 8, 12, 30, 200, 900)]
    units = [(u * 1500)[:1500] for u in (b"a", b"=-", b"ha! ", b"buy now! ", b"0123456789abcdef", bytes(range(40)))]
    return [*plain, *units, b"x" * 31, b"x" * 32, b"x" * 62, b"x" * 63, b"x" * 64, b"q", b"", bytes(rng.randrange(256) for _ in range(3000))]


@pytest.mark.parametrize("seed", [0, 1])
def test_window_choice_against_brute_force(seed):
    rank = np.random.default_rng(seed).permutation(ENTROPY_BINS) if seed else np.arange(ENTROPY_BINS)
    texts = odd_bytes()
    for text, got in zip(texts, digests(texts, rank)):
        places = np.array(brute_features(text, rank), np.int64)
        own = np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8)
        hashes = window_hashes(own, places, WINDOW // 8) if len(places) else np.zeros(0, np.uint64)
        want = digest_of(hashes if len(text) >= WINDOW else hashes + np.uint64(len(text)))
        assert got.text() == want.text()
        assert (got.features > 0) == (len(text) > 0)


def brute_likeness(one, other):
    if one.features > other.features:
        one, other = other, one
    if not one.features:
        return float(not other.features)
    left, right = ([set(np.flatnonzero(f).tolist()) for f in d.filters] for d in (one, other))
    total, rest = 0.0, one.features
    for f in left:
        weight = min(160, rest)
        rest -= weight
        best = 0.0
        for g in right:
            chance, most = len(f) * len(g) / 2048, min(len(f), len(g))
            best = max(best, (len(f & g) - chance) / max(most - chance, 1e-9))
        total += weight * min(best, 1.0)
    return total / one.features


def test_likeness_against_brute_force():
    rng, rank = random.Random(3), np.arange(ENTROPY_BINS)
    base = prose(rng, 2500)
    texts = odd_bytes() + [base.encode(), base[: len(base) // 2].encode(), (base[:3000] + prose(rng, 600)).encode()]
    own = digests(texts, rank)
    for a in own:
        for b in own:
            assert abs(likeness(a, b) - brute_likeness(a, b)) < 1e-5
    repeated = own[7:13]  # texts of one repeated unit are like themselves only
    assert all(likeness(a, b) < 0.5 and likeness(a, own[-5]) < 0.5 for a in repeated for b in repeated if a is not b)


def test_a_beginning_is_like_its_text_at_any_length():
    rng, rank = random.Random(8), np.arange(ENTROPY_BINS)
    for size in (200, 300, 362, 1000):
        text = prose(rng, 400).encode()[:size]
        whole, most, other = digests([text, text[: size * 5 // 6], prose(rng, 400).encode()[:size]], rank)
        assert likeness(whole, most) > 0.6 > 0.35 > likeness(whole, other)


def test_digests_follow_the_text():
    rng, rank = random.Random(5), np.arange(ENTROPY_BINS)
    texts = [prose(rng, n).encode() for n in (5, 30, 200, 3000)] + [b""]
    own = digests(texts, rank)
    assert [d.text() for d in digests(texts[::-1], rank)] == [d.text() for d in own[::-1]]
    assert all(likeness(d, d) == 1 for d in own) and likeness(own[2], own[4]) == 0
    half = digests([texts[3][: len(texts[3]) // 2] + prose(rng, 1500).encode()], rank)[0]
    assert 0.3 < likeness(own[3], half) < 0.8 and likeness(own[3], digests([prose(rng, 3000).encode()], rank)[0]) < 0.15


def test_fingerprints_of_documents(spark):
    import hashlib

    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(1, 400)) + " é" for _ in range(60)] + [None, "", "same text", "same text"]
    ids = [*range(0, 120, 2), 7, 9, 300, 301]
    df = spark.createDataFrame(list(zip(ids, texts, ids)), "doc_id bigint, text string, part int").repartition(6)
    rows = {r.id: r for r in fingerprint_documents(df).collect()}
    order, by = sorted(ids), dict(zip(ids, texts))
    assert sorted(rows) == order
    for doc, after in zip(order, order[1:] + order[:1]):
        text = edit(by[doc] or "", by[after] or "")
        assert rows[doc].edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert rows[doc].n_chars == len(by[doc] or "")
    assert rows[300].fingerprint == rows[301].fingerprint and rows[300].near_next == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    twice = spark.createDataFrame([(None, "x"), (None, "x"), (5, "y")], "doc_id bigint, text string")
    assert fingerprint_documents(twice).count() == 3
    assert fingerprint_documents(df.limit(0)).count() == 0


QUESTION = "A train with 120 seats leaves the old station at 9 and carries 45 people for 30 miles before Maria counts the 45 people again"


LONG = " ".join(random.Random(77).sample(VOCABULARY, 60))


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, QUESTION), (2, "short one here now"), (3, None), (None, "no id at all for this one"), (4, "two words"), (5, LONG)]
    return spark.createDataFrame(items, "item_id int, text string")


def test_decontamination_of_planted_cases(spark, benchmark):
    rng = random.Random(9)
    texts = {
        1: prose(rng, 30) + " " + QUESTION + " " + prose(rng, 30),
        2: prose(rng, 5) + ". " + QUESTION.replace("45", "62").replace("120", "7").replace("Maria", "Peter").upper().lower().replace("peter", "Peter"),
        3: QUESTION.replace("45 people for", "62 people for").replace("120", "7"),  # 45 stands for two values
        4: prose(rng, 200),
        5: "and a short one here now it is",
        6: None,
        7: "two words",
        8: QUESTION[: len(QUESTION) // 4],
        9: prose(rng, 20) + " " + " ".join(LONG.split()[20:44]) + " " + prose(rng, 20),  # 24 tokens of 60 in a row
        10: " ".join(LONG.split()[20:32]) + " " + prose(rng, 20),  # 12 in a row
        11: "here are two words among others",
        12: prose(rng, 200_000),
        13: QUESTION.replace("120", "9").replace("45", "9").replace("30", "9"),  # three values become one
    }
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()] + [(1, texts[1], 1)], "doc_id bigint, text string, item_id int")
    rows = {(r.id, r.item_id): r for r in find_contamination(df, benchmark).collect()}
    assert set(rows) == {(1, 1), (2, 1), (5, 2), (7, 4), (9, 5), (13, 1)}
    assert rows[9, 5].coverage < 0.5 and rows[13, 1].n_changed == 3
    assert rows[1, 1].n_changed == 0 and rows[1, 1].coverage > 0.9 and rows[2, 1].n_changed >= 3
    left = drop_contaminated(df, benchmark)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 8, 10, 11, 12]
    assert find_contamination(df.limit(0), benchmark).count() == 0
    assert drop_contaminated(df, benchmark.limit(0)).count() == df.count()


def test_a_long_text_with_many_found_windows(spark, benchmark):
    rng = random.Random(21)
    # the text's tokens once for each window found would be some 20 GB
    text = " ".join(f"{prose(rng, 400)}. {QUESTION.replace('120', str(500 + k))}." for k in range(200))
    df = spark.createDataFrame([(1, text), (2, prose(rng, 100))], "doc_id bigint, text string")
    row = find_contamination(df, benchmark).first()
    assert (row.id, row.item_id, row.n_windows, row.coverage) == (1, 1, row.item_windows, 1.0)
    assert row.n_changed >= 200
    assert [r.doc_id for r in drop_contaminated(df, benchmark).collect()] == [2]


def test_languages_from_several_kinds_of_evidence(spark):
    docs = spark.createDataFrame(
        [(k, "the and with that " * 20, "en") for k in range(20)] + [(k, "der die und nicht " * 20, "de") for k in range(20)] + [(99, "x", None)],
        "doc_id int, text string, lang string",
    )
    page = lambda lang, text: f"<html lang='{lang}'><script>var a</script><p>{text}</p></html>"
    rows = [(k, f"http://a{k % 3}.example.de/{k}", page("de", "und die nicht")) for k in range(30)]
    rows += [(k + 100, f"http://b{k % 3}.example.com/{k}", page("en", "that and the")) for k in range(30)]
    rows += [(500, "http://a1.example.de/x", page("de", "")), (501, "http://b1.example.com", page("en", "")), (502, None, None), (502, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("lang", F.lit("??"))
    found = identify_languages(pages, docs).collect()
    by = {r.id: r for r in found}
    assert len(found) == 64 and all(by[k].lang == "de" for k in range(30)) and all(by[k + 100].lang == "en" for k in range(30))
    assert by[500].lang == "de" and by[501].lang == "en" and by[502].host == "" and 0 < by[502].probability <= 1
    assert identify_languages(pages.limit(0), docs).count() == 0
    assert {r.lang for r in identify_languages(pages, docs.limit(0)).collect()} == {"und"}


def test_languages_against_brute_force(spark):
    """Trigram model, votes, smoothed priors and posteriors of the smallest tables."""
    folder = "/root/testdata/sf0.001"
    docs = [(r.lang, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.lang is not None]
    pages = {r.page_id: (r.url or "", r.html or "") for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    langs = sorted({lang for lang, _ in docs})
    seen = {lang: Counter() for lang in langs}
    for lang, text in docs:
        seen[lang].update(language.trigrams(text).tolist())
    size = {lang: sum(seen[lang].values()) + 0.5 * language.TRIGRAMS for lang in langs}
    texts, parts = {}, {}
    for k, (url, page) in pages.items():
        found = language.trigrams(language.visible(page)).tolist()
        weight = min(language.TEXT_WEIGHT, len(found))
        texts[k] = [weight * sum(math.log((seen[x][t] + 0.5) / size[x]) for t in found) / len(found) if found else 0.0 for x in langs]
        parts[k] = (*language.address(url), language.declared(page), langs[int(np.argmax(texts[k]))] if found else None)
    votes = [Counter((parts[k][at], parts[k][4]) for k in pages if parts[k][4]) for at in range(4)]
    total = Counter(parts[k][4] for k in pages if parts[k][4])
    base = {x: (total[x] + 1) / (sum(total.values()) + len(langs)) for x in langs}
    for row in QUERIES["op7_language"](spark, folder).collect():
        own = parts[row.page_id]
        assert (row.host, row.suffix, row.declared, row.text_lang) == (own[0], own[2], own[3], own[4])
        host, domain, suffix, claim = ({x: votes[at][own[at], x] - (x == own[4]) for x in langs} for at in range(4))
        domain = {x: (domain[x] + language.DOMAIN_WEIGHT * base[x]) / (sum(domain.values()) + language.DOMAIN_WEIGHT) for x in langs}
        prior = {x: (host[x] + language.HOST_WEIGHT * domain[x]) / (sum(host.values()) + language.HOST_WEIGHT) for x in langs}
        evidence = [
            t + math.log(prior[x]) + math.log((suffix[x] + 0.5) / (total[x] + 1)) + math.log((claim[x] + 0.5) / (total[x] + 1))
            for x, t in zip(langs, texts[row.page_id])
        ]
        chance = np.exp(np.array(evidence) - max(evidence))
        chance /= chance.sum()
        assert abs(row.probability - chance.max()) < 1e-3
        assert chance[langs.index(row.lang)] > chance.max() - 1e-3


def test_quality_against_brute_force(spark):
    """Statistics, features, normal equations, calibration and scores of the smallest tables, in one piece."""
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).alias("fold")
    docs = {r.doc_id: (r.text or "", r.fold) for r in table.select("doc_id", "text", fold).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [k for k in labels if k in docs and zlib.crc32(str(k).encode()) % 4 != 2]
    stats = {k: np.array(quality.statistics(text)) for k, (text, _) in docs.items()}
    known = np.array([stats[k] for k in rows])
    mean, scale = known.mean(0), known.std(0)
    scale[scale < 1e-9] = 1.0
    y, half = np.array([labels[k] for k in rows], float), np.array([docs[k][1] for k in rows])
    z = quality.fourier(known, mean, scale)

    def ridge(some):
        a, n = z[some].T @ z[some], some.sum()
        penalty = np.full(len(a), quality.RIDGE * max(n, 1) / len(a))
        penalty[0] = 1e-9
        return np.linalg.solve(a + np.diag(penalty), z[some].T @ y[some])

    raw = np.where(half == 0, z @ ridge(half == 1), z @ ridge(half == 0))
    bins = np.clip(np.round(raw * quality.BINS), -quality.BINS, 2 * quality.BINS)
    x = np.unique(bins)
    knots, values = isotonic(x / quality.BINS, *(np.array([f[bins == b].sum() for b in x]) for f in (y, np.ones(len(y)))))
    weights = ridge(np.ones(len(y), bool))
    got = {r.doc_id: r.score for r in QUERIES["op9_quality"](spark, folder).collect()}
    assert set(got) == set(docs)
    for k, score in got.items():
        want = np.interp(quality.fourier(stats[k][None], mean, scale) @ weights, knots, values)[0]
        assert abs(score - min(max(want, 0.0), 1.0)) < 1e-3
