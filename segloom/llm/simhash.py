"""Near-duplicate groups by SimHash, probed with the general pigeonhole principle."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import packed, staged, unpacked, with_package
from segloom.llm.components import connected_components

BITS = 64
SEED = 42


def fingerprint(text: str, words: int) -> int:
    """Signed 64-bit SimHash of the text's shingles, repeats included; zero if it has no word."""
    tokens = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        found = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[: -words] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        found = [digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    return majority(np.array(found, dtype=np.uint64))


def majority(found: np.ndarray, step: int = 65_536) -> int:
    """The bits set in over half of the hashes, as a signed number; none: zero."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(found), step):
        octets = found[at : at + step].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(found)).tobytes(), "big", signed=True)


def with_fingerprint(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``fp``; batches go through Arrow, one text at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), fps], ["id", "text_hash", "fp"]
            )

    plain = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    return plain.mapInArrow(add, "id bigint, text_hash bigint, fp bigint")


@dataclass(frozen=True)
class Part:
    """A group of bits and the number of differing bits that a probe may bridge in it."""

    bits: tuple[int, ...]
    radius: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        return flips(self.bits, self.radius)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def flips(bits: tuple[int, ...], radius: int) -> list[int]:
    """All masks with up to ``radius`` of the bits set."""
    return [
        _signed(sum(1 << b for b in chosen))
        for r in range(radius + 1)
        for chosen in itertools.combinations(bits, r)
    ]


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, in how many both are set.

    Every task sums a 64 x 64 table over its own rows; the tables are added by a grouped sum,
    and 4,096 numbers reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            rows += len(values)
            for at in range(0, len(values), 16_384):
                bits = (values[at : at + 16_384, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
                bits = bits.astype(np.float32)
                total += bits.T @ bits
        if rows:
            cell = np.arange(BITS * BITS + 1)
            counts = np.append(total.ravel(), rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts)], ["cell", "n"])

    sums = fps.select("fp").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    table = np.zeros(BITS * BITS + 1)
    for row in sums.collect():
        table[row.cell] = row.n
    return int(table[-1]), table[:-1].reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        seed = max(sorted(free), key=lambda b: related[b, sorted(free)].sum())
        group = [seed]
        free.discard(seed)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: related[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(tuple(sorted(group)))
    return groups


def within(p: np.ndarray, radius: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... ``radius`` of the bits."""
    chance = np.zeros(radius + 2)
    chance[0] = 1.0
    for one in 2 * p * (1 - p):
        chance[1:] = chance[1:] * (1 - one) + chance[:-1] * one
        chance[0] *= 1 - one
    return np.cumsum(chance[: radius + 1])


#: Cost of a probe row that crosses the network, in checks of a candidate pair.
PROBE_COST = 8.0


def plan_parts(both: np.ndarray, n: int, distance: int) -> list[Part]:
    """Bit groups with the thresholds of least estimated work.

    By the general pigeonhole principle two fingerprints that differ in at most ``distance``
    bits differ in at most ``t_i`` bits of some group ``i`` if the ``t_i + 1`` sum to
    ``distance + 1``; a group with ``t_i = -1`` is not probed. For each number of groups the
    thresholds are found by dynamic programming over groups, on probe rows plus the candidate
    pairs expected from all fingerprints' bit frequencies.
    """
    p = np.diag(both) / max(n, 1)
    best: tuple[float, list[Part]] | None = None
    for m in range(2, distance + 2):
        groups = group_bits(both, n, m)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            chance = within(p[list(group)], distance)
            shapes = np.cumsum([len(list(itertools.combinations(group, r))) if r < 3 else _choose(len(group), r) for r in range(distance + 1)])
            cost = [0.0] + [PROBE_COST * n * (s + 1) + n * n / 2 * c for s, c in zip(shapes, chance)]
            after: dict[int, tuple[float, list[int]]] = {}
            for used, (paid, chosen) in states.items():
                for take in range(distance + 2 - used):
                    option = (paid + cost[take], [*chosen, take - 1])
                    if used + take not in after or option[0] < after[used + take][0]:
                        after[used + take] = option
            states = after
        paid, chosen = states[distance + 1]
        if best is None or paid < best[0]:
            best = paid, [Part(g, t) for g, t in zip(groups, chosen) if t >= 0]
    return best[1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _literals(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _entry(number: int, part: Part) -> Column:
    """Where a fingerprint stands in the index of a group."""
    return F.struct(F.lit(number).alias("part"), F.col("fp").bitwiseAND(F.lit(part.mask).cast("bigint")).alias("key"))


def _probe(number: int, part: Part) -> Column:
    """Where it looks for others."""
    key = F.col("fp").bitwiseAND(F.lit(part.mask).cast("bigint"))
    keys = F.transform(_literals(part.flips()), lambda x: key.bitwiseXOR(x))
    return F.struct(F.lit(number).alias("part"), keys.alias("keys"))


def fingerprint_links(fps: DataFrame, distance: int = 4, crowded: int = 256) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct fingerprints within ``distance`` bits.

    ``fps`` has one row per distinct ``fp``. The links have the same connected components as
    the graph of all pairs within ``distance``; each link is such a pair.

    Every fingerprint is indexed under its bits in each group of ``plan_parts`` and probes
    all values within the group's threshold; a hit is checked over all bits. A key with more
    than ``crowded`` fingerprints is not paired out. Whoever probes such a key is linked by way
    of midpoints instead: two fingerprints are within ``distance`` exactly if some value is
    within half of it from both, so each goes to all values that near and is linked to one of
    those it meets there. At most as many distinct fingerprints meet at a value as there are
    values near it (2,081 for 4 bits), so no group grows with the data, and the work is linear in
    the crowd.
    """
    n, both = bit_counts(fps)
    parts = plan_parts(both, n, distance)
    index = fps.select("fp", F.inline(F.array(*[_entry(i, p) for i, p in enumerate(parts)])))
    probes = fps.select("fp", F.inline(F.array(*[_probe(i, p) for i, p in enumerate(parts)])))
    probes = probes.select("fp", "part", F.explode("keys").alias("key"))
    full = index.groupBy("part", "key").count().where(F.col("count") > crowded).select("part", "key")
    full = staged(full, "simhash-full")
    open_keys = index.join(full, ["part", "key"], "left_anti").withColumnRenamed("fp", "other")
    targets = open_keys.unionByName(full.withColumn("other", F.lit(None).cast("bigint")))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    hits = probes.join(targets, ["part", "key"]).where(
        F.col("other").isNull() | ((F.col("other") < F.col("fp")) & near)
    )
    hits = staged(hits.select(F.col("other").alias("a"), F.col("fp").alias("b")), "simhash-hits")
    crowd = hits.where("a is null").select(F.col("b").alias("fp")).distinct()
    return hits.where("a is not null").unionByName(midpoint_links(crowd, distance)).distinct()


def midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links with the components of all pairs within ``distance``, without forming the pairs."""
    inner, outer = distance // 2, distance - distance // 2
    bits = tuple(range(BITS))
    spread = fps.select("fp", F.explode(_literals(flips(bits, outer))).alias("flip"))
    spread = spread.select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("flip")).alias("at"),
        F.when(F.bit_count("flip") <= inner, F.col("fp")).alias("close"),
    )
    centre = spread.groupBy("at").agg(F.min("close").alias("a"), F.count(F.lit(1)).alias("n"))
    centre = centre.where("n > 1 and a is not null").select("at", "a")
    return spread.join(centre, "at").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def grouped(docs: DataFrame, words: int, distance: int, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``text_hash`` and ``fp`` of every row, and of its group ``keeper``: the first by (id, text_hash)."""
    with_package(docs.sparkSession)
    marked = staged(with_fingerprint(packed(docs, id_column, text_column), words), "simhash")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    fps = marked.groupBy("fp").agg(F.min(place).alias("first"))
    links = fingerprint_links(fps.select("fp"), distance)
    groups = connected_components(links).withColumnRenamed("node", "fp")
    # a fingerprint without a link is its own group
    firsts = fps.join(groups, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    # each side of a join by group or fingerprint is a table, so that adaptive execution can split a large one
    firsts = staged(firsts, "simhash-firsts")
    keepers = staged(firsts.groupBy("component").agg(F.min("first").alias("keeper")), "simhash-keepers")
    named = staged(firsts.join(keepers, "component").select("fp", "keeper"), "simhash-named")
    return marked.join(named, "fp")


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    distance: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Fingerprint and group of every document.

    Words are runs without ASCII white space, A-Z lower-cased; a shingle is ``words`` words
    joined by a space (all words if there are fewer). A bit of the fingerprint is set if it is
    set in over half of the shingles' XXH64 values (seed 42), repeats included. Documents whose
    fingerprints differ in at most ``distance`` bits are linked. Returns ``id``, ``fingerprint``
    (16 hex digits) and ``component_id``, the smallest id that can be reached.

    Texts are read once and do not cross the network. Copies are one fingerprint from then on,
    however many there are; see ``fingerprint_links`` for the search.

    Defined cases: null, empty and blank texts have fingerprint zero and are linked with each
    other like any other; repeated rows are one row each, in one group; a row without id is
    treated like any other, the smallest id leaves it out, and a group without any id has a null
    ``component_id``; an empty table gives an empty table.
    """
    return grouped(docs, words, distance, id_column, text_column).select(
        "id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("keeper.id").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    words: int = 4,
    distance: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group of ``near_duplicates``: the one with the smallest id (no id: last).

    Among rows with that id the one whose text has the smallest hash stays, once.
    """
    keep = (
        grouped(docs, words, distance, id_column, text_column)
        .where("id <=> keeper.id and text_hash = keeper.text_hash")
        .select(F.col("id").alias("keep_id"), F.col("text_hash").alias("keep_hash"))
        .distinct()
        .hint("shuffle_hash")
    )
    rows = packed(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash"))
    once = Window.partitionBy("id", "text_hash").orderBy("text_hash")
    kept = rows.join(keep, same, "left_semi").withColumn("nth", F.row_number().over(once)).where("nth = 1")
    return unpacked(kept)
