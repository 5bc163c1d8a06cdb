"""Toxicity by votes of the nearest labelled examples, found exactly in a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.calibrate import isotonic
from segloom.llm.common import packed, quoted, staged, text_or_empty, with_package

#: Labelled rows of each class that become examples, at most.
EXAMPLES = 2_000
NEIGHBOURS = 15
#: Examples of a block, and blocks that are searched before the others are held against the best found.
BLOCK = 256
FIRST = 3
#: Votes of an example at distance 0 are worth 1 / NEAREST, those of the common share PRIOR.
NEAREST = 0.05
PRIOR = 1.0
#: Share of the vote itself in a score, so that equal calibrated scores keep the order of their votes.
TILT = 0.02
WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> Counter:
    """Lower-case words with their numbers."""
    return Counter(WORD.findall(text.lower()))


def evidence_weight(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Twice the log likelihood ratio of a term's documents, ``a`` of ``n1`` and ``b`` of ``n0``, against one common rate."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        ratio = np.where(seen > 0, seen, 1) / np.maximum(np.where(seen > 0, expected, 1), 1e-9)
        return np.where(seen > 0, seen * np.log(ratio), 0.0)

    rate = (a + b) / max(n1 + n0, 1)
    total = part(a, rate * n1) + part(b, rate * n0) + part(n1 - a, (1 - rate) * n1) + part(n0 - b, (1 - rate) * n0)
    return np.maximum(2 * total, 0.0) + 1e-3


@dataclass
class ExampleIndex:
    """Inverted lists of all terms over example blocks, with the largest weight of each term in each block."""

    terms: dict[str, int]
    factor: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    peaks: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(1), np.full(1, 0.5)))
    unmatched: float = 0.5

    @staticmethod
    def build(ids: np.ndarray, labels: np.ndarray, terms: list[str], example: np.ndarray, term: np.ndarray, count: np.ndarray) -> ExampleIndex:
        """``example``, ``term`` and ``count`` are the entries of the examples' term counts, by example."""
        held = np.bincount(example, minlength=len(ids)) > 0
        toxic = labels[example] > 0
        a = np.bincount(term[toxic], minlength=len(terms)).astype(np.float64)
        b = np.bincount(term[~toxic], minlength=len(terms)).astype(np.float64)
        idf = np.log((1 + held.sum()) / (1 + a + b)) + 1
        factor = idf * evidence_weight(a, b, int(labels[held].sum()), int((labels[held] == 0).sum()))
        weight = (1 + np.log(count)) * factor[term]
        weight = weight / np.sqrt(np.bincount(example, weight**2, minlength=len(ids)))[example]
        # alike examples side by side, so that few blocks can hold a query's neighbours
        by = np.lexsort((term, -weight, example))
        strongest = np.full(len(ids), len(terms))
        lead = by[np.flatnonzero(np.diff(example[by], prepend=-1))]
        strongest[example[lead]] = term[lead]
        order = np.lexsort((ids, labels, strongest))
        order = order[held[order]]
        place = np.full(len(ids), -1)
        place[order] = np.arange(len(order))
        blocks = max(1, -(-len(order) // BLOCK))
        example = place[example]
        by = np.lexsort((example, term))
        term, example, weight = term[by], example[by], weight[by]
        cell = term * blocks + example // BLOCK
        peaks = np.zeros(len(terms) * blocks, np.float32)
        np.maximum.at(peaks, cell, np.nextafter(weight.astype(np.float32), np.float32(2)))
        return ExampleIndex(
            {t: k for k, t in enumerate(terms)},
            factor,
            ids[order],
            labels[order].astype(np.float64),
            example.astype(np.int32),
            weight,
            np.searchsorted(cell, np.arange(len(terms) * blocks + 1)).astype(np.int32),
            peaks.reshape(len(terms), blocks),
        )

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        own = sorted((self.terms[t], n) for t, n in counts.items() if t in self.terms)
        if not own:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.array([k for k, _ in own])
        value = (1 + np.log([n for _, n in own])) * self.factor[at]
        return at, value / np.linalg.norm(value)

    def vectors(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The examples' own vectors."""
        blocks = self.peaks.shape[1]
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.bounds[::blocks]))
        by = np.argsort(self.examples, kind="stable")
        ends = np.searchsorted(self.examples[by], np.arange(len(self.ids) + 1))
        return [(term[by[a:b]], self.weights[by[a:b]]) for a, b in zip(ends, ends[1:])]

    def _cosines(self, at: np.ndarray, value: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Cosines with all examples of ``some`` blocks, 0 elsewhere."""
        cells = at[:, None] * self.peaks.shape[1] + some
        low = self.bounds[cells].ravel().astype(np.int64)
        many = self.bounds[cells + 1].ravel() - low
        ends = np.cumsum(many)
        if not len(ends) or not ends[-1]:
            return np.zeros(len(self.ids))
        entries = np.arange(ends[-1]) + np.repeat(low - ends + many, many)
        parts = self.weights[entries] * np.repeat(np.repeat(value, len(some)), many)
        return np.bincount(self.examples[entries], parts, minlength=len(self.ids))

    def nearest(self, at: np.ndarray, value: np.ndarray, k: int = NEIGHBOURS, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` most similar examples (cosine over 0), the first place among equals.

        The blocks whose largest weights allow the highest cosines are searched first; of the others only those that
        can reach the k-th best found.
        """
        limit = value @ self.peaks[at]
        order = np.argsort(-limit, kind="stable")
        order = order[limit[order] > 0]
        found = self._cosines(at, value, order[:FIRST])
        if leave >= 0:
            found[leave] = 0
        best = self._best(found, k)
        floor = found[best[-1]] if len(best) == k else 0.0
        rest = order[FIRST:]
        rest = rest[limit[rest] >= floor - 1e-9]
        if len(rest):
            more = self._cosines(at, value, rest)
            if leave >= 0:
                more[leave] = 0
            found = found + more
            best = self._best(found, k)
        return best, found[best]

    @staticmethod
    def _best(found: np.ndarray, k: int) -> np.ndarray:
        places = np.flatnonzero(found > 0)
        if len(places) > k:
            floor = np.partition(found[places], len(places) - k)[len(places) - k]
            places = places[found[places] >= floor]
        return places[np.lexsort((places, -found[places]))][:k]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float | None:
        """Share of toxic neighbours, each weighed by the inverse of its distance, with a little of the share of all examples."""
        if not len(places):
            return None
        weight = 1 / (NEAREST + 1 - np.minimum(cosines, 1.0))
        return float(((weight * self.labels[places]).sum() + PRIOR * self.labels.mean()) / (weight.sum() + PRIOR))

    def score(self, counts: Counter) -> tuple[float, list[tuple[int, int, float]]]:
        places, cosines = self.nearest(*self.vector(counts))
        vote = self.vote(places, cosines)
        if vote is None:
            return self.unmatched, []
        evidence = [(int(self.ids[p]), int(self.labels[p]), float(c)) for p, c in zip(places[:3], cosines[:3])]
        return float((1 - TILT) * np.interp(vote, *self.calibration) + TILT * vote), evidence


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "toxic",
    examples: int = EXAMPLES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> ExampleIndex:
    """An index of at most ``examples`` labelled documents of each class, those of the smallest id hashes.

    All words of the examples are terms; weights are TF-IDF times the term's evidence, the likelihood ratio of its
    documents' split between the classes. Every example votes on every other, in tasks; isotonic calibration of those
    votes, weighed to the classes' shares among all ``labels``, turns votes into scores. Texts without any term
    score the share of toxic examples among such texts. Rows without id or label are left
    out; an id labelled twice counts once (its larger label). No labelled document: every score is 0.5.
    """
    spark = with_package(docs.sparkSession)
    known = (
        labels.select(F.col(quoted(id_column)).cast("bigint").alias("id"), F.col(quoted(label_column)).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    sizes = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    some = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(examples) for y in (0, 1)]
    texts = docs.select(F.col(quoted(id_column)).cast("bigint").alias("id"), text_or_empty(text_column).alias("text"))
    # twice ``examples`` rows of two numbers at most
    rows = texts.join(F.broadcast(some[0].unionByName(some[1])), "id").withColumn("text_hash", F.xxhash64("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t) for t in batch.column("text").to_pylist()]
            terms = pa.array([list(c) for c in counts], pa.list_(pa.string()))
            arrays = [batch.column(c) for c in ("id", "label", "text_hash")]
            arrays += [terms, pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "text_hash", "terms", "counts"])

    described = rows.select("id", "label", "text_hash", "text").mapInArrow(
        describe, "id bigint, label int, text_hash bigint, terms array<string>, counts array<int>"
    )
    # the words of at most twice ``examples`` texts
    found = staged(described, "toxicity-fit").toArrow().sort_by([("id", "ascending"), ("text_hash", "ascending")]).combine_chunks()
    if not found.num_rows:
        return ExampleIndex.build(np.zeros(0, np.int64), np.zeros(0, np.int64), [], *[np.zeros(0, np.int64)] * 3)
    lists = pa.concat_arrays(found.column("terms").chunks)
    codes = lists.flatten().dictionary_encode()
    example = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    counts = pa.concat_arrays(found.column("counts").chunks).flatten().to_numpy()
    label = found.column("label").to_numpy()
    index = ExampleIndex.build(
        found.column("id").to_numpy(), label, codes.dictionary.to_pylist(), example, codes.indices.to_numpy().astype(np.int64), counts
    )
    weight = {y: sizes[y] / max((label == y).sum(), 1) for y in sizes}
    lonely = [(int(y), weight[int(y)]) for y, n in zip(label, np.diff(lists.offsets.to_numpy())) if not n]
    index.unmatched = (sum(y * w for y, w in lonely) + 0.05) / (sum(w for _, w in lonely) + 1)
    votes = _votes(spark, index)
    by_vote: dict[float, list[float]] = {}
    for place, vote in votes:
        cell = by_vote.setdefault(round(0.5 if vote is None else vote, 3), [0.0, 0.0])
        cell[0] += index.labels[place] * weight[int(index.labels[place])]
        cell[1] += weight[int(index.labels[place])]
    x = np.array(sorted(by_vote))
    index.calibration = isotonic(x, *(np.array([by_vote[v][k] for v in sorted(by_vote)]) for k in (0, 1)))
    return index


def _votes(spark, index: ExampleIndex) -> list[tuple[int, float | None]]:
    """Each example's vote by the others; one number per example is collected."""
    shared, many = spark.sparkContext.broadcast(index), len(index.ids)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        vectors = own.vectors()
        for batch in batches:
            places = batch.column("id").to_pylist()
            votes = [own.vote(*own.nearest(*vectors[p], leave=p)) for p in places]
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(votes, pa.float64())], ["place", "vote"])

    rows = spark.range(0, many, 1, max(1, many // 200)).mapInArrow(vote, "place bigint, vote double").collect()
    shared.unpersist()
    return sorted((r.place, r.vote) for r in rows)


def score_toxicity(docs: DataFrame, index: ExampleIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``score`` (0 to 1) and ``evidence``, the up to three nearest examples with label and cosine.

    Each text is scored where it is read; the index, bounded by its examples, goes to every executor once.
    Null and empty texts have no term and score like other texts without one; repeated rows score
    alike; examples at the same distance count in the index's order; an empty table gives an empty table.
    """
    spark = with_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(index)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            results = [own.score(term_counts(t)) for t in batch.column("text").to_pylist()]
            evidence = [[dict(zip(("doc_id", "label", "cosine"), e)) for e in r[1]] for r in results]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([r[0] for r in results], pa.float64()), pa.array(evidence, kind)],
                ["id", "score", "evidence"],
            )

    rows = packed(docs, id_column, text_column).select("id", "text")
    return rows.mapInArrow(score, "id bigint, score double, evidence array<struct<doc_id:bigint,label:int,cosine:double>>")
