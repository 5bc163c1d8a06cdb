"""Quality scores: ridge regression on random Fourier features of document statistics."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.calibrate import isotonic
from segloom.llm.common import quoted, staged, text_or_empty, with_package

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 20_000
FEATURES = 256
#: Of the Gaussian kernel, in standard deviations of a statistic times the root of their number.
BANDWIDTH = 1.0
RIDGE = 1e-4
BINS = 1000

#: Bytes that are counted together.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".", b",", b"|", b"!?", b"%$#&*@~^+=<>", b";:-_/\\'\"()[]{}"]


def statistics(text: str) -> list[float]:
    """Lengths, shares of characters, repetition and line shape of a whole text."""
    octets = text.encode()
    words, lines = text.split(), text.split("\n")
    if not words:
        return [0.0] * STATISTICS
    bytes_of = np.bincount(np.frombuffer(octets, np.uint8), minlength=256)
    size, many = len(octets), len(words)
    share = bytes_of[bytes_of > 0] / size
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.float64, many)
    repeats = sum(map(operator.eq, words, words[1:]))
    return [
        np.log1p(size),
        np.log1p(many),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(counts) / many,
        np.log(len(counts)) / np.log(many + 1),
        max(counts.values()) / many,
        repeats / many,
        np.sqrt(repeats / many),
        (lengths <= 3).mean(),
        len(lines) / many,
        1 - len(set(lines)) / len(lines),
        float(-(share * np.log2(share)).sum()),
        bytes_of[128:].sum() / size,
        *[bytes_of[list(c)].sum() / size for c in CLASSES],
        *[np.sqrt(bytes_of[list(c)].sum() / many) for c in CLASSES[5:8]],
        bytes_of[list(CLASSES[0])].sum() / max(1, bytes_of[list(CLASSES[0] + CLASSES[1])].sum()),
    ]


STATISTICS = 15 + len(CLASSES) + 3 + 1


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    #: False if no labelled document was found.
    fitted: bool = True

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        stats = np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, STATISTICS)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant and random cosines whose products approach a Gaussian kernel; the draw is fixed."""
    draw = np.random.default_rng(7)
    directions = draw.normal(size=(STATISTICS, FEATURES)) / (BANDWIDTH * np.sqrt(STATISTICS))
    phases = draw.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / scale, -6, 6)
    return np.hstack([np.ones((len(z), 1)), np.sqrt(2 / FEATURES) * np.cos(z @ directions + phases)])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    fit_rows: int = FIT_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityModel:
    """Fits on at most ``fit_rows`` of the ``labels`` (id, 0/1), those of the smallest id hashes.

    Every task sums the normal equations of its rows; the cells are added by a grouped sum and
    some 70,000 numbers reach the driver. Two halves of the rows are kept apart until then: each
    half is scored by the other's weights, and isotonic calibration takes these scores, in
    ``BINS`` bins, with the labels. Rows without id or label are left out, and an id labelled twice
    counts once (its larger label). No labelled document: every score is 0.5.
    """
    with_package(docs.sparkSession)
    chosen = (
        labels.select(F.col(quoted(id_column)).cast("bigint").alias("id"), F.col(quoted(label_column)).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(fit_rows)
    )
    texts = docs.select(F.col(quoted(id_column)).cast("bigint").alias("id"), text_or_empty(text_column).alias("text"))
    # at most fit_rows rows of two numbers
    rows = texts.join(F.broadcast(chosen), "id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fold"), batch.column("label"), pa.array(stats, pa.list_(pa.float64()))],
                ["fold", "label", "stats"],
            )

    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(2)).cast("int").alias("fold")
    described = rows.select(fold, "label", "text").mapInArrow(describe, "fold int, label int, stats array<double>")
    described = staged(described, "quality-fit")
    moments = described.agg(
        *[F.avg(F.get("stats", F.lit(k))).alias(f"m{k}") for k in range(STATISTICS)],
        *[F.stddev_pop(F.get("stats", F.lit(k))).alias(f"s{k}") for k in range(STATISTICS)],
    ).first()
    mean = np.array([moments[f"m{k}"] or 0.0 for k in range(STATISTICS)])
    scale = np.array([moments[f"s{k}"] or 0.0 for k in range(STATISTICS)])
    scale[scale < 1e-9] = 1.0
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size + 2))
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), np.float64).reshape(-1, STATISTICS)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
            half = batch.column("fold").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                z, y = fourier(stats[half == k], mean, scale), label[half == k]
                sums[k, :, :size] += z.T @ z
                sums[k, :, size] += z.T @ y
                sums[k, 0, size + 1] += len(y)
        used = np.nonzero(sums.ravel())[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums.ravel()[used])], ["cell", "v"])

    cells = described.mapInArrow(equations, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    total = np.zeros(2 * size * (size + 2))
    for row in cells.collect():
        total[row.cell] = row.v
    halves = total.reshape(2, size, size + 2)
    if not halves[:, 0, size + 1].sum():
        return QualityModel(mean, scale, np.zeros(size), np.zeros(1), np.full(1, 0.5), fitted=False)
    solved = [solve(h) for h in (halves[1], halves[0], halves.sum(0))]

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), np.float64).reshape(-1, STATISTICS)
            half = batch.column("fold").to_numpy(zero_copy_only=False)
            z = fourier(stats, mean, scale)
            raw = np.where(half == 0, z @ solved[0], z @ solved[1])
            bins = np.clip(np.round(raw * BINS), -BINS, 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    pairs = described.mapInArrow(cross, "bin bigint, label int").groupBy("bin")
    pairs = pairs.agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    x, p, n = (np.array([row[c] for row in pairs], np.float64) for c in ("bin", "p", "n"))
    knots, values = isotonic(x / BINS, p, n)
    return QualityModel(mean, scale, solved[2], knots, values)


def solve(sums: np.ndarray) -> np.ndarray:
    """Ridge weights from summed normal equations; the constant is not shrunk."""
    size = len(sums)
    penalty = np.full(size, RIDGE * max(sums[0, size + 1], 1.0) / size)
    penalty[0] = 1e-9
    return np.linalg.solve(sums[:, :size] + np.diag(penalty), sums[:, size])


def quality_score(model: QualityModel, text: Column) -> Column:
    """A column of calibrated scores between 0 and 1; null and empty texts are scored like any other."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(texts.to_pylist()), pa.float64())

    return score(F.coalesce(text.cast("string"), F.lit("")))
