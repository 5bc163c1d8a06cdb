"""Near-duplicates by the similarity of shingle sets: SimHash, then an exact prefix-filtered join, with verified pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import packed, staged, unpacked, with_package
from segloom.llm.components import connected_components
from segloom.llm.simhash import fingerprint_links, majority

SEED = 42
#: Words of a shingle, and the Jaccard similarity of shingle sets from which two texts are near-duplicates.
WORDS = 5
SIMILARITY = 0.8
#: Differing bits of the SimHash fingerprints up to which two texts are looked at first.
DISTANCE = 4
#: Share of the texts (one of so many) that common shingles are counted in, and the count that makes one common.
SAMPLE = 8
COMMON = 64
#: Common shingles that go to every executor; more only cost time.
COMMON_ROWS = 200_000
#: Texts to verify that are sent for by broadcast.
BROADCAST_ROWS = 500_000
#: Columns of a sketch, of 64 bits each.
SKETCH = [f"s{k}" for k in range(16)]


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: runs of ``words`` words, all words if there are fewer."""
    tokens = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    runs = len(tokens) - width + 1
    mixed = np.full(runs, SEED + width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashed[k : k + runs]) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xC4CEB9FE1A85EC53)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def prefix(found: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in the common order (common ones last, else by hash) of which similar sets share one.

    Sets with a similarity of ``similarity`` share that part of either of them at least, so one
    of the shared shingles is among those before the rest.
    """
    size = len(found) - int(np.ceil(similarity * len(found) - 1e-9)) + 1 if len(found) else 0
    if len(common) and len(found):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        often = common[at] == found
        found = np.concatenate((found[~often], found[often]))
    return found[:size]


def last_rank(first: np.ndarray, common: np.ndarray) -> int:
    """Place of a prefix's last shingle in the common order, but for the two lowest bits of its hash."""
    if not len(first):
        return 0
    at = min(int(np.searchsorted(common, first[-1])), len(common) - 1)
    return int(first[-1] >> np.uint64(2)) | (int(at >= 0 and common[at] == first[-1]) << 62)


def sketch(found: np.ndarray) -> np.ndarray:
    """1,024 bits, each the parity of the shingles that fall on it; two sets differ in no fewer shingles than bits."""
    cells = np.bincount((found >> np.uint64(54)).astype(np.int64), minlength=64 * len(SKETCH))
    return np.packbits(cells & 1).view(np.int64)


def fine_sketch(found: np.ndarray) -> bytes:
    """Parity bits by the lowest bits of the hashes, four to eight for each shingle and 1,024 at least."""
    bits = max(64 * len(SKETCH), 1 << (4 * len(found)).bit_length())
    cells = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(cells & 1).tobytes()


def apart(one: bytes, other: bytes) -> int:
    """The bits in which two fine sketches differ; the longer one is folded until both are of one length."""
    left, right = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    while len(left) != len(right):
        left, right = sorted((left, right), key=len)
        half = len(right) // 2
        right = right[:half] ^ right[half:]
    return int(np.bitwise_count(left ^ right).sum())


def common_shingles(rows: DataFrame, words: int, similarity: float) -> np.ndarray:
    """Shingles that many texts of a sample begin with in hash order; they only decide the order of search."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            own = [prefix(shingle_set(t, words), none, similarity) for t in batch.column("text").to_pylist()]
            every = np.concatenate(own) if own else none
            yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64))], ["h"])

    sample = rows.where(F.pmod("text_hash", F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(first, "h bigint").groupBy("h").count().where(F.col("count") >= COMMON)
    found = counts.orderBy(F.desc("count"), "h").limit(COMMON_ROWS).select("h").collect()
    return np.sort(np.array([r.h for r in found], np.int64).view(np.uint64))


def with_sets(rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """``id``, ``text_hash``, ``node`` (hash of the shingle set), its size ``n``, SimHash ``fp``, sketch and ``prefix`` of every row."""
    common = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, words, similarity))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, last, bits, first, fine, fps = [], [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, words)
                node.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                size.append(len(found))
                fps.append(majority(found))
                bits.append(sketch(found))
                fine.append(fine_sketch(found))
                first.append(prefix(found, common.value, similarity).view(np.int64))
                last.append(last_rank(first[-1].view(np.uint64), common.value))
            bits = np.array(bits, np.int64).reshape(-1, len(SKETCH))
            ends = np.concatenate(([0], np.cumsum([len(f) for f in first]))).astype(np.int32)
            flat = np.concatenate(first) if first else np.zeros(0, np.int64)
            arrays = [
                pa.array(np.array(node, np.uint64).view(np.int64)),
                pa.array(size, pa.int32()),
                pa.array(last, pa.int64()),
                *[pa.array(bits[:, k].copy()) for k in range(len(SKETCH))],
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(fine, pa.binary()),
                pa.array(fps, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), *arrays], ["id", "text_hash", "node", "n", "last", *SKETCH, "prefix", "fine", "fp"]
            )

    bits = ", ".join(f"{s} bigint" for s in SKETCH)
    return rows.mapInArrow(describe, f"id bigint, text_hash bigint, node bigint, n int, last bigint, {bits}, prefix array<bigint>, fine binary, fp bigint")


def _may_reach(a: str, b: str, similarity: float) -> Column:
    """False only if sizes or sketches rule the similarity out."""
    n = lambda side: F.col(f"{side}.n")
    apart = reduce(add, [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH])
    sizes = F.least(n(a), n(b)) >= similarity * F.greatest(n(a), n(b)) - 1e-6
    return sizes & (apart <= (1 - similarity) / (1 + similarity) * (n(a) + n(b)) + 1e-6)


def _overlap_bound(similarity: float) -> Column:
    """The most shingles that two sets can share whose prefixes share ``shared``.

    What the set whose prefix ends first has in its prefix and shares lies in the other's prefix as well.
    """
    left, right = (F.ceil(similarity * F.col(n) - 1e-9) - 1 for n in ("n_l", "n_r"))
    behind = F.when(F.col("last_l") < F.col("last_r"), left).when(F.col("last_l") > F.col("last_r"), right)
    return F.col("shared") + behind.otherwise(F.greatest(left, right))


def near_enough(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``: nodes) that sketches as fine as the sets do not rule out.

    A pair's sketches take a tenth of its texts, and leave few pairs whose similarity is not just short of enough.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, None
        for batch in batches:
            good = []
            for a, b, n, fine in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n", "fine"))):
                if pair == (a, b):
                    if apart(held[1], fine) <= (1 - similarity) / (1 + similarity) * (held[0] + n) + 1e-6:
                        good.append(pair)
                pair, held = (a, b), (n, fine)
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    asked = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node")).join(sets.select("node", "n", "fine"), "node")
    asked = asked.select("a", "b", "node", "n", "fine").repartition("a", "b").sortWithinPartitions("a", "b", "node")
    return asked.mapInArrow(compare, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``: nodes) whose shingle sets reach ``similarity``.

    The texts of a pair meet once, and no set is written: texts are smaller than the hashes of their shingles.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, {}
        for batch in batches:
            good = []
            for a, b, node, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "node", "text"))):
                if pair != (a, b):
                    pair, held = (a, b), {k: v for k, v in held.items() if k in (a, b)}
                # a set of the pair before, or of a repeated row, is not formed again
                held[node] = held[node] if node in held else shingle_set(text, words)
                if len(held) == 2:
                    left, right = held.values()
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    if shared * (1 + similarity) >= (len(left) + len(right)) * similarity - 1e-6:
                        good.append(pair)
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    asked = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
    asked = staged(asked.join(sets.select("node", "first"), "node").select("a", "b", "node", "first.*"), "similar-asked")
    asked = asked.select("a", "b", "node", F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"))
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    same = (F.col("text_hash") == F.col("own_hash")) & F.col("id").eqNullSafe(F.col("own_id"))
    texts = rows.join(asked, same).select("a", "b", "node", "text").repartition("a", "b").sortWithinPartitions("a", "b", "node")
    return staged(texts.mapInArrow(compare, "a bigint, b bigint").distinct(), "similar-links")


def fingerprint_pairs(sets: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a``, ``b`` of nodes that connect all whose SimHash fingerprints are within ``distance`` bits.

    Sets of one fingerprint are paired with the smallest of them, and these by ``fingerprint_links``: no more pairs
    than sets and links.
    """
    fps = staged(sets.groupBy("fp").agg(F.min("node").alias("low")), "similar-fps")
    same = sets.select("node", "fp").join(fps, "fp").where("node <> low").select("low", "node")
    ends = [fps.select(F.col("fp").alias(side), F.col("low").alias(f"low_{side}")) for side in "ab"]
    links = fingerprint_links(fps.select("fp"), distance).join(ends[0], "a").join(ends[1], "b")
    pairs = same.toDF("x", "y").unionByName(links.select(F.col("low_a").alias("x"), F.col("low_b").alias("y")))
    return staged(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "similar-fingerprints")


def left_apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those of the ``pairs`` whose nodes are not in one of the ``groups`` (``node``, ``component``)."""
    sides = [groups.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")) for side in "ab"]
    named = pairs.join(sides[0], "a", "left").join(sides[1], "b", "left")
    return named.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def similar_links(sets: DataFrame, rows: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` with the connected components of all pairs of sets of at least ``similarity``.

    SimHash comes first: each node is compared with the smallest that ``fingerprint_pairs`` pairs it with. That misses
    most pairs that are just similar enough, and what it leaves apart is searched by shingles, which misses none:
    similar sets share a shingle of their prefixes. Each node is compared with one other, of those that
    are the smallest around one of its shingles the one it shares most with, and then all pairs around a
    shingle that are not yet connected are. Sizes, sketches, the number of shared shingles and at last
    sketches as fine as the sets rule pairs out before their texts meet.
    """
    # one pair for a node: the smallest that its sketch does not rule out
    asked = near_enough(fingerprint_pairs(sets), sets, similarity).groupBy("b").agg(F.min("a").alias("a"))
    asked = staged(asked.select("a", "b"), "similar-hashed")
    links = verified(asked, sets, rows, words, similarity)
    alike = staged(connected_components(links), "similar-alike")
    keys = sets.select("node", F.explode("prefix").alias("h"))
    ends = keys.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    met = staged(keys.join(ends.where("low < high").select("h", "low"), "h"), "similar-met")
    plain = sets.select("node", "n", "last", *SKETCH)
    star = met.where("low < node").groupBy(F.col("low").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    star = star.join(plain.alias("l"), F.col("a") == F.col("l.node")).join(plain.alias("r"), F.col("b") == F.col("r.node"))
    star = star.where(_may_reach("l", "r", similarity)).groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best"))
    star = staged(left_apart(star.select("best.a", "b"), alike), "similar-pairs")
    links = staged(links.unionByName(verified(star, sets, rows, words, similarity)), "similar-first")
    asked = asked.unionByName(star)
    groups = staged(connected_components(links), "similar-groups")
    held = met.select("h", "node").join(groups, "node", "left")
    held = staged(held.select("h", "node", F.coalesce("component", "node").alias("component")), "similar-held")
    mixed = held.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("h")
    open_keys = staged(held.join(mixed, "h").join(plain, "node"), "similar-open")
    rest = open_keys.alias("l").join(
        open_keys.alias("r"),
        (F.col("l.h") == F.col("r.h")) & (F.col("l.component") < F.col("r.component")) & _may_reach("l", "r", similarity),
    )
    # all shingles that the two prefixes share are among the open ones, as the two are not connected
    sides = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "lr" for c in ("node", "n", "last")]
    rest = rest.select(*sides).groupBy("node_l", "n_l", "last_l", "node_r", "n_r", "last_r").agg(F.count(F.lit(1)).alias("shared"))
    rest = rest.where(_overlap_bound(similarity) >= similarity / (1 + similarity) * (F.col("n_l") + F.col("n_r")) - 1e-6)
    rest = rest.select(F.least("node_l", "node_r").alias("a"), F.greatest("node_l", "node_r").alias("b"))
    rest = staged(rest.join(asked, ["a", "b"], "left_anti"), "similar-rest")
    rest = staged(near_enough(rest, sets, similarity), "similar-near")
    return links.unionByName(verified(rest, sets, rows, words, similarity))


def similar_groups(docs: DataFrame, words: int, similarity: float, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``text_hash`` and ``node`` of every row, and of its group ``keeper``: the first by (id, text_hash)."""
    with_package(docs.sparkSession)
    rows = packed(docs, id_column, text_column).select("id", F.xxhash64("text").alias("text_hash"), "text")
    marked = staged(with_sets(rows, words, similarity), "similar")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "text_hash")
    sets = marked.groupBy("node").agg(F.min(place).alias("first"), *[F.first(c).alias(c) for c in ("n", "last", *SKETCH, "prefix", "fine", "fp")])
    sets = staged(sets, "similar-sets")
    groups = connected_components(similar_links(sets, rows, words, similarity))
    firsts = sets.select("node", "first").join(groups, "node", "left")
    # each side of a join by group or set is a table, so that adaptive execution can split a large one
    firsts = staged(firsts.select("node", "first", F.coalesce("component", "node").alias("component")), "similar-firsts")
    keepers = staged(firsts.groupBy("component").agg(F.min("first").alias("keeper")), "similar-keepers")
    named = staged(firsts.join(keepers, "component").select("node", "keeper"), "similar-named")
    return marked.select("id", "text_hash", "node").join(named, "node")


def drop_similar(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group of similar texts: the one with the smallest id (no id: last).

    Two texts are similar if their sets of shingles (``words`` words, A-Z lower-cased, all words if
    there are fewer) have a Jaccard similarity of at least ``similarity``; similar texts are linked,
    and a group is what links connect. No pair is missed: see ``similar_links``. Among rows with the
    smallest id the one whose text has the smallest hash stays, once.

    Defined cases: null, empty and blank texts are similar to each other only; repeated rows are one
    group; a row without id is treated like any other; an empty table gives an empty table.
    """
    keep = (
        similar_groups(docs, words, similarity, id_column, text_column)
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
