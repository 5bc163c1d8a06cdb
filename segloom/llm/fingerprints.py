"""Similarity digests: improbable byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import packed, with_package

WINDOW = 32
#: A window is selected if it is the rarest of this many or more of the 32 stretches of 32 windows around it.
POPULAR = 8
FILTER_BITS = 2048
HASHES = 5
#: Features in a filter before the next one is begun.
CAPACITY = 160
ENTROPY_BINS = 1024
#: Bytes that are worked on together, so that they stay near the processor.
AT_ONCE = 1 << 17
#: Bytes of text in a part of the ordered table.
PART_BYTES = 16 << 20


def entropy_bins(octets: np.ndarray) -> np.ndarray:
    """The entropy of each window of ``WINDOW`` bytes, in equal steps.

    Windows are moved by a byte at a time: the sum of n log n over byte counts changes by what the
    entering byte finds of its kind within the window's bytes before it, and the leaving one after it.
    """
    n = len(octets)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = octets[d:] == octets[:-d]
        before[d:] += same
        after[:-d] += same
    counts = np.arange(WINDOW + 1, dtype=np.float64)
    whole = np.round(counts * np.log2(np.maximum(counts, 1)) * (1 << 20)).astype(np.int64)
    step = np.diff(whole)
    total = np.cumsum(step[before])
    total[WINDOW:] -= np.cumsum(step[after])[:-WINDOW]
    bits = np.log2(WINDOW) - total[WINDOW - 1 :] / (WINDOW << 20)
    return np.clip(bits / np.log2(WINDOW) * (ENTROPY_BINS - 1), 0, ENTROPY_BINS - 1).astype(np.int64)


def window_hashes(octets: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """A 64-bit hash of the ``8 * words`` bytes at each place."""
    view = np.ndarray(len(octets) - 7, "<u8", octets.tobytes(), strides=(1,))
    mixed = np.full(len(at), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words):
        mixed = (mixed ^ view[at + 8 * k]) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    return mixed ^ (mixed >> np.uint64(32))


@dataclass(frozen=True)
class Digest:
    """Filters (one row of bits each) and the number of features in all."""

    filters: np.ndarray
    features: int

    def text(self) -> str:
        octets = np.packbits(self.filters, axis=1).tobytes()
        return f"{self.features}:{base64.b64encode(octets).decode()}"


def digest_of(features: np.ndarray) -> Digest:
    """Distinct features in order of first occurrence, ``CAPACITY`` to a filter."""
    _, first = np.unique(features, return_index=True)
    own = features[np.sort(first)]
    filters = np.zeros((-(-len(own) // CAPACITY), FILTER_BITS), np.uint8)
    row = np.arange(len(own)) // CAPACITY
    for j in range(HASHES):
        filters[row, (own >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)] = 1
    return Digest(filters, len(own))


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """The digest of each text; ``rank`` orders entropies from rare to frequent."""
    out: list[Digest] = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= AT_ONCE:
            out += _digests(group, rank)
            group, size = [], 0
    return out + _digests(group, rank)


def _digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """A text's features are the windows that are the rarest of ``POPULAR`` stretches or more, the first among equals.

    A text of fewer than ``WINDOW`` windows is one stretch. Where no window is that popular (a unit repeats), the most
    popular ones are taken, so that every text but the empty one has a feature; one shorter than a window is
    filled up.
    """
    octets = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    popular = np.zeros(len(octets) + 1, np.int64)
    if len(octets) >= WINDOW:
        place = np.arange(len(octets) - WINDOW + 1)
        rare = (rank[entropy_bins(octets)] << 40) | place
        low, span = rare, 1
        while span < WINDOW:
            low = np.minimum(low[:-span], low[span:]) if len(low) > span else low[:0]
            span *= 2
        inside = np.zeros(len(low), bool)  # stretches that lie in one text
        alone = []
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            if b - a >= 2 * WINDOW - 1:
                inside[a : b - 2 * WINDOW + 2] = True
            elif b - a >= WINDOW:
                alone.append(int(rare[a : b - WINDOW + 1].min()) & ((1 << 40) - 1))
        popular[: len(octets)] = np.bincount(low[inside] & ((1 << 40) - 1), minlength=len(octets))
        popular[alone] = POPULAR
        found = np.add.reduceat(popular >= POPULAR, np.minimum(starts[:-1], len(octets)))
        for k in np.flatnonzero((found == 0) & (np.diff(starts) >= WINDOW)).tolist():
            own = popular[starts[k] : starts[k + 1]]
            own[own == own.max()] = POPULAR
    chosen = np.flatnonzero(popular >= POPULAR)
    hashes = window_hashes(octets, chosen, WINDOW // 8) if len(chosen) else np.zeros(0, np.uint64)
    cut = np.searchsorted(chosen, starts)
    out = []
    for k, text in enumerate(texts):
        if len(text) >= WINDOW:
            out.append(digest_of(hashes[cut[k] : cut[k + 1]]))
        elif text:
            own = np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8)
            out.append(digest_of(window_hashes(own, np.zeros(1, np.int64), WINDOW // 8) + np.uint64(len(text))))
        else:
            out.append(digest_of(np.zeros(0, np.uint64)))
    return out


def likeness(one: Digest, other: Digest, rows: int = 512) -> float:
    """Bit overlap beyond chance, 0 to 1.

    Each filter of the digest with fewer features is held against all filters of the other; the best
    overlap counts, scaled so that what two random filters share is 0 and the smaller filter
    inside the larger is 1. Filters weigh as their features. Two digests without features are alike.
    """
    if one.features > other.features:
        one, other = other, one
    if not one.features:
        return float(not other.features)
    right = other.filters.astype(np.float32)
    right_size = right.sum(1)
    weights = np.full(len(one.filters), CAPACITY, np.float64)
    weights[-1] = one.features - CAPACITY * (len(weights) - 1)
    total = 0.0
    for at in range(0, len(one.filters), rows):
        left = one.filters[at : at + rows].astype(np.float32)
        size = left.sum(1)[:, None]
        chance = size * right_size / FILTER_BITS
        most = np.minimum(size, right_size)
        shared = (left @ right.T - chance) / np.maximum(most - chance, 1e-9)
        total += float((np.clip(shared, 0, 1).max(1) * weights[at : at + rows]).sum())
    return total / float(weights.sum())


def entropy_ranks(rows: DataFrame) -> np.ndarray:
    """Rank of each entropy bin among all windows of all texts, the rarest first.

    Tasks count their windows; a grouped sum adds the counts, and one number per bin is collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(ENTROPY_BINS, np.int64)
        for batch in batches:
            group, size = [], 0
            for text in batch.column("text").to_pylist():
                group.append(text.encode())
                size += len(group[-1])
                if size >= AT_ONCE:
                    _count(group, seen)
                    group, size = [], 0
            _count(group, seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENTROPY_BINS)), pa.array(seen)], ["bin", "n"])

    sums = rows.select("text").mapInArrow(count, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    seen = np.zeros(ENTROPY_BINS, np.int64)
    for row in sums.collect():
        seen[row.bin] = row.n
    rank = np.empty(ENTROPY_BINS, np.int64)
    rank[np.argsort(seen, kind="stable")] = np.arange(ENTROPY_BINS)
    return rank


def _count(texts: list[bytes], seen: np.ndarray) -> None:
    bins = entropy_bins(np.frombuffer(b"".join(texts), np.uint8))
    inside, at = np.zeros(len(bins), bool), 0
    for text in texts:
        inside[at : max(at, at + len(text) - WINDOW + 1)] = True
        at += len(text)
    seen += np.bincount(bins[inside], minlength=ENTROPY_BINS)


@dataclass(frozen=True)
class Order:
    """Parts of the table by ascending (place, text_hash), and the first row of each part that has rows."""

    bounds: np.ndarray
    firsts: dict[int, tuple[int, int]]

    def part(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right")

    def before(self) -> dict[int, int]:
        """The part before each part, round the end."""
        parts = sorted(self.firsts)
        return {p: parts[k - 1] for k, p in enumerate(parts)}


def plan_order(rows: DataFrame) -> Order:
    """Bounds of parts of about ``PART_BYTES``; one number and one row per part are collected."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    shares = [k / parts for k in range(1, parts)]
    bounds = rows.approxQuantile("place", shares, 0.1 / parts) if shares else []
    bounds = np.unique(np.array(bounds, np.float64).astype(np.int64))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, tuple[int, int]] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            hashed = batch.column("text_hash").to_numpy()
            order = np.lexsort((hashed, place))
            part = np.searchsorted(bounds, place[order], side="right")
            for p, at in zip(*np.unique(part, return_index=True)):
                row = (int(place[order[at]]), int(hashed[order[at]]))
                low[int(p)] = min(row, low.get(int(p), row))
        columns = [(p, *row) for p, row in low.items()]
        arrays = [pa.array(c, pa.int64()) for c in (zip(*columns) if columns else ([], [], []))]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "place", "text_hash"])

    found = rows.select("place", "text_hash").mapInArrow(first, "part bigint, place bigint, text_hash bigint")
    found = found.groupBy("part").agg(F.min(F.struct("place", "text_hash")).alias("first")).collect()
    return Order(bounds, {r.part: (r["first"].place, r["first"].text_hash) for r in found})


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Digests of every text and of the text as edited by the next document's.

    Windows of ``WINDOW`` bytes are ranked by how rare their entropy is among all windows of the table; a
    window that is the rarest of its surroundings is a feature, and features go into a chain of
    Bloom filters. The edited text has its last ``n_chars // 2`` code points replaced by the first
    as many (or all) of the next document's, in ascending order of id, the first after the last. Returns ``id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    Texts cross the network once: they go to parts of the order, and the first row of each part also
    to the part before, as the successor of its last row.

    Defined cases: null and empty texts have no features and are alike (1) with each other only; all other texts
    have some, of one kind, whatever their length; rows with one id follow each other in the order of their text's
    hash, rows without id come first, in that order (spread over the places below -2**62, with such ids); a table
    of one row is its own successor; an empty table gives an empty table.
    """
    with_package(docs.sparkSession)
    rows = packed(docs, id_column, text_column).select("id", F.xxhash64("text").alias("text_hash"), "text")
    # rows without id lie at many places, so that they do not all go to one part
    nowhere = F.lit(-(1 << 63)).cast("bigint") + F.shiftright(F.col("text_hash"), 2) + F.lit(1 << 61)
    rows = rows.select("id", F.coalesce("id", nowhere).alias("place"), "text_hash", "text")
    order = plan_order(rows)
    rank = entropy_ranks(rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = order.before()
        for batch in batches:
            place, hashed = batch.column("place").to_numpy(), batch.column("text_hash").to_numpy()
            part = order.part(place)
            ahead = [k for k, p in enumerate(part.tolist()) if order.firsts[p] == (place[k], hashed[k])]
            for take, to, tail in (
                (None, part, False),
                (pa.array(ahead, pa.int64()), np.array([before[part[k]] for k in ahead], np.int64), True),
            ):
                own = batch if take is None else batch.take(take)
                arrays = [pa.array(to, pa.int64()), pa.array([tail] * len(to), pa.bool_()), *own.columns]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "tail", *own.schema.names])

    routed = rows.mapInArrow(route, "part bigint, tail boolean, id bigint, place bigint, text_hash bigint, text string")
    ordered = routed.repartition("part").sortWithinPartitions("part", "tail", "place", "text_hash")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row of the batch before, with its digest
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "id", "text"))))
            own = digests([r[3].encode() for r in rows], rank)
            if held:
                rows, own = [held[0], *rows], [held[1], *own]
            pairs = [k for k in range(len(rows) - 1) if not rows[k][1]]
            edited = [edit(rows[k][3], rows[k + 1][3]) for k in pairs]
            others = digests([t.encode() for t in edited], rank)
            out = [
                (
                    rows[k][2],
                    len(rows[k][3]),
                    hashlib.sha256(text.encode()).hexdigest(),
                    own[k].text(),
                    other.text(),
                    likeness(own[k], other),
                    likeness(own[k], own[k + 1]),
                )
                for k, text, other in zip(pairs, edited, others)
            ]
            held = (rows[-1], own[-1])
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], RESULT)

    return ordered.select("part", "tail", "id", "text").mapInArrow(
        describe,
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


RESULT = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]
