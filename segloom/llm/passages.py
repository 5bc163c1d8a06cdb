"""Passages that documents repeat, located by sharded Aho-Corasick automata of their phrases, and removed."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import packed, quoted, staged, text_or_empty, with_package
from segloom.llm.words import chunks, joined, mixed, rolling, split_words, word_codes

#: Words of a window, and of the phrases that stand for windows.
WINDOW = 50
PHRASE = 10
#: Phrases of an automaton, and blocks of windows of a shard, about; a shard with several times as many blocks
#: (one document's copies) is searched in several tasks.
PHRASES = 2_000
BLOCKS = 2_000
SALTED = 4
#: Repeated windows that a task holds at once, about.
WINDOWS = 200_000
#: Documents that are asked for by broadcast; more are asked for by a shuffle.
BROADCAST_ROWS = 500_000

FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Odd factors of the two digests of a window.
DIGEST_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours; fewer at the end."""
    out, size = keys.copy(), 1
    while size < width:
        step = min(size, width - size)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


def phrase_blocks(codes: np.ndarray, hashes: np.ndarray, ends: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, ...]:
    """Document, two hashes of the phrase, its place, first and last window of each block of windows.

    A window's phrase is the one of its phrases with the lowest hash, the first of equals: equal windows have
    the same phrase at the same place. A block is neighbouring windows of a document with one and the same.
    """
    sizes = np.diff(ends)
    within = np.arange(len(codes)) - np.repeat(ends[:-1], sizes)
    starts = np.flatnonzero(within + window <= np.repeat(sizes, sizes))
    if not len(starts):
        return (np.zeros(0, np.int64),) * 6
    own = hashes[codes]
    one = mixed(rolling(own, phrase, FACTORS[0]))
    keys = one >> np.uint64(32) << np.uint64(32) | np.arange(len(codes), dtype=np.uint64)
    at = (lowest(keys, window - phrase + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    first, last, at = starts[new], starts[np.append(new[1:], len(starts)) - 1], at[new]
    other = np.zeros(len(at), np.uint64)
    for k in range(phrase):
        other = mixed(other * FACTORS[1] + own[at + k])
    document = np.searchsorted(ends, first, side="right") - 1
    begin = ends[document]
    return document, one[at].view(np.int64), other.view(np.int64), at - begin, first - begin, last - begin


def _blocks(texts: DataFrame, window: int, phrase: int) -> DataFrame:
    """``id``, ``text_hash``, ``h1``, ``h2``, ``at``, ``a``, ``b`` of all blocks of all documents."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words, ends = split_words(batch.column("text"))
            codes, distinct = word_codes(words)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))
            document, h1, h2, at, a, b = phrase_blocks(codes, hashes, ends, window, phrase)
            rows = pa.array(document)
            arrays = [batch.column("id").take(rows), batch.column("text_hash").take(rows), pa.array(h1), pa.array(h2)]
            arrays += [pa.array(x.astype(np.int32)) for x in (at, a, b)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text_hash", "h1", "h2", "at", "a", "b"])

    return staged(texts.mapInArrow(find, "id bigint, text_hash bigint, h1 bigint, h2 bigint, at int, a int, b int"), "passage-blocks")


def _cut(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    """Per document and shard its phrases (kind 0, of the first document that has them) and the stretches to search (kind 1)."""
    names = ["shard", "salt", "salts", "kind", "id", "text_hash", "start", "text", "at", "a", "b"]
    ints = pa.list_(pa.int32())
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), ints, ints, ints]
    for batch in chunks(batches, size=1_000_000):
        out: list[tuple] = []
        for number, text_hash, text, routes in zip(*(batch.column(c).to_pylist() for c in ("id", "text_hash", "text", "routes"))):
            words = text.encode().split()
            for route in routes:
                shard, salts, open_ = route["shard"], route["salts"], []

                def close() -> None:
                    start, end = open_[0]["a"], open_[-1]["b"] + window  # noqa: B023
                    places = [[block[c] - start for block in open_] for c in ("at", "a", "b")]  # noqa: B023
                    out.append((shard, route["salt"], salts, 1, number, text_hash, start, b" ".join(words[start:end]).decode(), *places))  # noqa: B023

                for block in route["blocks"]:
                    if block["first"]:
                        own = b" ".join(words[block["at"] : block["at"] + phrase]).decode()
                        out.extend((shard, salt, salts, 0, None, None, None, own, None, None, None) for salt in range(salts))
                    if open_ and block["a"] > open_[-1]["b"] + window:
                        close()
                        open_ = []
                    open_.append(block)
                close()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


def window_digests(codes: np.ndarray, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of the ``window`` words from each word on; the last ones are short of words."""
    own = hashes[codes]
    out = []
    for factor in DIGEST_FACTORS:
        total, power, place, have = np.zeros(len(own), np.uint64), 1, 0, 1
        block, step = mixed(own ^ factor), int(factor)
        # the hash of a window is put together from those of 1, 2, 4, ... words
        while place < window:
            if window & have:
                total[: len(own) - place] += block[place:] * np.uint64(power)
                place += have
                power = power * step % 2**64
            block[: max(len(own) - have, 0)] += block[have:] * np.uint64(step)
            step, have = step * step % 2**64, have * 2
        out.append(mixed(total).view(np.int64))
    return out[0], out[1]


def text_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts in a row, where each text's begin, their codes, and the hash of each code."""
    words, ends = split_words(texts)
    codes, distinct = word_codes(words)
    return words, ends, codes, np.fromiter(map(xxhash.xxh64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))


def spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each ``first`` to its ``last``, in a row."""
    many = last - first + 1
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + many, many)


class Occurrences:
    """Places of phrases in stretches of words, by an automaton over characters."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.compiled = False

    def add(self, phrase: str) -> None:
        self.automaton.add_word(f" {phrase} ", len(phrase) + 1)

    def places(self, text: str, sizes: np.ndarray) -> set[int]:
        """The words of ``text`` (of ``sizes`` characters) that a phrase begins with."""
        if not self.compiled:
            self.automaton.make_automaton()
            self.compiled = True
        if not len(self.automaton):
            return set()
        found = [end - size for end, size in self.automaton.iter(f" {text} ")]
        return set(np.searchsorted(np.cumsum(sizes + 1), np.array(found, np.int64), side="right").tolist())


STRETCH = ("id", "text_hash", "start", "text", "a", "b")


def _locate(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The windows around located phrases: their digests with the smallest and largest document, and the stretches again."""
    names = ["kind", "shard", "salt", "d1", "d2", "low", "high", *STRETCH]
    ints = pa.list_(pa.int32())
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.string(), ints, ints]
    group, search = None, Occurrences()
    for batch in chunks(batches):
        texts = batch.column("text")
        _, ends, codes, hashes = (words := text_words(texts))
        sizes = pc.utf8_length(words[0]).to_numpy(zero_copy_only=False).astype(np.int64)
        columns = (batch.column(c).to_pylist() for c in ("shard", "salt", "kind", "id", "text_hash", "start", "text", "at", "a", "b"))
        out: list[tuple] = []
        first, last, owner = [], [], []
        for row, (shard, salt, kind, number, text_hash, start, text, at, a, b) in enumerate(zip(*columns)):
            if group != (shard, salt):
                group, search = (shard, salt), Occurrences()
            if kind == 0:
                search.add(text)
                continue
            places = search.places(text, sizes[ends[row] : ends[row + 1]])
            good = [k for k, place in enumerate(at) if place in places]
            if not good:
                continue
            first.extend(ends[row] + a[k] for k in good)
            last.extend(ends[row] + b[k] for k in good)
            owner.extend((shard, number) for _ in good)
            out.append((1, shard, salt, None, None, None, None, number, text_hash, start, text, [a[k] for k in good], [b[k] for k in good]))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)
        if not first:
            continue
        first, last, owner = np.array(first), np.array(last), np.array(owner, np.int64)
        at = spans(first, last)
        shard, number = (np.repeat(owner[:, k], last - first + 1) for k in (0, 1))
        d1, d2 = (d[at] for d in window_digests(codes, hashes, window))
        by = np.lexsort((number, d2, d1, shard))
        shard, d1, d2, number = shard[by], d1[by], d2[by], number[by]
        new = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))))
        end = np.append(new[1:], len(number)) - 1
        n = len(new)
        arrays = [pa.array(np.zeros(n, np.int32)), pa.array(shard[new].astype(np.int32)), pa.nulls(n, pa.int32())]
        arrays += [pa.array(x) for x in (d1[new], d2[new], number[new], number[end])]
        yield pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(n, t) for t in kinds[7:]]], names)


class Known:
    """Repeated windows of a shard by digest, with the smallest document that has each."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.sorted: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def add(self, d1: np.ndarray, d2: np.ndarray, low: int) -> None:
        self.parts.append((d1, d2, np.full(len(d1), low)))

    def smallest(self, d1: np.ndarray, d2: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """The smallest document of each window, ``otherwise`` where it is not repeated."""
        if self.sorted is None:
            columns = [np.concatenate(c) for c in zip(*self.parts)] if self.parts else [np.zeros(0, np.int64)] * 3
            by = np.lexsort((columns[1], columns[0]))
            self.sorted = tuple(c[by] for c in columns)
        one, two, low = self.sorted
        out = otherwise.copy()
        at = np.searchsorted(one, d1)
        open_ = np.arange(len(d1))
        while len(open_):  # once, unless two windows have the same first digest
            open_ = open_[at[open_] < len(one)]
            open_ = open_[one[at[open_]] == d1[open_]]
            hit = two[at[open_]] == d2[open_]
            out[open_[hit]] = low[at[open_[hit]]]
            open_ = open_[~hit]
            at[open_] += 1
        return out


def _judge(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Stretches of words that lie in windows which a smaller document has as well."""
    group, known = None, Known()
    for batch in chunks(batches):
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("shard", "sub", "salt"))))
        low = batch.column("low").to_pylist()
        k = 0
        while k < len(keys):
            if group != keys[k]:
                group, known = keys[k], Known()
            if low[k] is not None:
                known.add(*(batch.column(c)[k].values.to_numpy() for c in ("d1", "d2")), low[k])
                k += 1
                continue
            end = k
            while end < len(keys) and keys[end] == group:
                end += 1
            yield _removed(batch.slice(k, end - k), known, window)
            k = end


def _removed(rows: pa.RecordBatch, known: Known, window: int) -> pa.RecordBatch:
    _, ends, codes, hashes = text_words(rows.column("text"))
    blocks = np.diff(rows.column("a").offsets.to_numpy())
    a, b = (rows.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b"))
    base = np.repeat(ends[:-1], blocks)
    at = spans(base + a, base + b)
    row = np.repeat(np.repeat(np.arange(rows.num_rows), blocks), b - a + 1)
    number = rows.column("id").to_numpy()[row]
    d1, d2 = (d[at] for d in window_digests(codes, hashes, window))
    gone = np.flatnonzero(known.smallest(d1, d2, number) < number)
    at, row = at[gone], row[gone]
    new = np.ones(len(at), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + window)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    own = row[first]
    shift = rows.column("start").to_numpy()[own] - ends[own]
    stretch = [(at[first] + shift).astype(np.int32), (at[last] + shift + window).astype(np.int32)]
    arrays = [rows.column(c).take(pa.array(own)) for c in ("id", "text_hash")]
    return pa.RecordBatch.from_arrays([*arrays, *map(pa.array, stretch)], ["id", "text_hash", "start", "end"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        words, ends = split_words(batch.column("text"))
        edges = np.zeros(len(words) + 1, np.int64)
        for k, gaps in enumerate(batch.column("gaps").to_pylist()):
            for gap in gaps or []:
                edges[ends[k] + gap["start"]] += 1
                edges[ends[k] + gap["end"]] -= 1
        kept = np.cumsum(edges)[:-1] <= 0
        left = np.concatenate(([0], np.cumsum(kept)))[ends]
        text = joined(words.filter(pa.array(kept)), left)
        sizes = np.diff(ends)
        arrays = [batch.column("row"), pa.array(sizes), pa.array(sizes - np.diff(left)), text]
        yield pa.RecordBatch.from_arrays(arrays, ["row", "n_words", "n_removed", "kept_text"])


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def repeated_stretches(docs: DataFrame, window: int, phrase: int, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``text_hash`` and ``gaps`` (start, end in words) of documents with windows that a smaller one has too."""
    key = ["id", "text_hash"]
    texts = packed(docs, id_column, text_column).where("id is not null").select("id", F.xxhash64("text").alias("text_hash"), "text")
    blocks = _blocks(texts, window, phrase)
    repeated = blocks.groupBy("h1", "h2").agg(F.min("id").alias("source"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = staged(repeated.where("source < last").select("h1", "h2", "source", "n"), "passage-phrases")
    phrases, found = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-phrases // PHRASES), -(-found // BLOCKS))
    shard = F.pmod(F.xxhash64("source"), F.lit(shards)).cast("int").alias("shard")
    met = blocks.join(repeated.select("h1", "h2", "source", shard), ["h1", "h2"])
    block = F.struct("a", "b", "at", (F.col("id") == F.col("source")).alias("first"))
    routes = staged(met.groupBy(*key, "shard").agg(F.sort_array(F.collect_set(block)).alias("blocks")), "passage-routes")
    salts = F.ceil(F.sum(F.size("blocks")) / (SALTED * BLOCKS)).cast("int").alias("salts")
    sizes = staged(routes.groupBy("shard").agg(salts), "passage-shards")
    groups = sizes.agg(F.sum("salts")).first()[0] or 1
    salt = F.pmod(F.xxhash64(*key, "shard"), F.col("salts")).cast("int").alias("salt")
    asked = routes.join(sizes, "shard").groupBy(*key).agg(F.collect_list(F.struct("shard", salt, "salts", "blocks")).alias("routes"))
    asked = staged(asked, "passage-asked")
    wanted = texts.join(_few(asked.select(*key)), key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
    cut = wanted.join(asked, key).mapInArrow(
        lambda b: _cut(b, window, phrase),
        "shard int, salt int, salts int, kind int, id bigint, text_hash bigint, start int, text string, at array<int>, a array<int>, b array<int>",
    )
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups)
    streamed = cut.repartition(tasks, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    located = streamed.mapInArrow(
        lambda b: _locate(b, window),
        "kind int, shard int, salt int, d1 bigint, d2 bigint, low bigint, high bigint, id bigint, text_hash bigint, start int, text string, a array<int>, b array<int>",
    )
    located = staged(located, "passage-located")
    again = located.where("kind = 0").groupBy("shard", "d1", "d2").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    again = staged(again.where("low < high").select("shard", "d1", "d2", "low"), "passage-windows")
    # a shard with very many windows is parted once more, by their digests; its stretches go to every part
    subs = F.ceil(F.count(F.lit(1)) / WINDOWS).cast("int").alias("subs")
    parts = staged(again.groupBy("shard").agg(subs).join(sizes, "shard"), "passage-parts")
    sub = F.pmod(F.xxhash64("d1", "d2"), F.col("subs")).cast("int").alias("sub")
    nothing = {"id": "bigint", "text_hash": "bigint", "start": "int", "text": "string", "a": "array<int>", "b": "array<int>"}
    held = again.join(parts, "shard").groupBy("shard", sub, "salts", "low")
    held = held.agg(F.collect_list(F.struct("d1", "d2")).alias("digests")).select(
        "shard", "sub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "digests.d1", "digests.d2", "low",
        *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()],
    )
    none = [F.lit(None).cast("array<bigint>").alias(c) for c in ("d1", "d2")]
    searched = located.where("kind = 1").join(parts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), "salt", *none, F.lit(None).cast("bigint").alias("low"), *nothing
    )
    both = held.unionByName(searched).repartition(tasks, "shard", "sub", "salt")
    gaps = both.sortWithinPartitions("shard", "sub", "salt", F.col("low").isNull()).mapInArrow(
        lambda b: _judge(b, window), "id bigint, text_hash bigint, start int, end int"
    )
    return staged(gaps.groupBy(*key).agg(F.collect_set(F.struct("start", "end")).alias("gaps")), "passage-gaps")


def drop_repeated_passages(
    docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_words``, ``n_removed`` and ``kept_text``.

    Words that a window of ``window`` words covers are removed if the same words in a row also begin in a
    document with a smaller id; windows are judged on the input. The kept words have one blank between them.

    Each window is stood for by one of its phrases of ``phrase`` words, chosen by content, so that equal windows meet.
    Phrases that two documents have are confirmed by their words: those of the smallest document go into the
    automaton of a shard, and all stretches of documents that may hold the shard's phrases are streamed through
    it. The windows around what it locates are compared by digests of 128 bits. Shards go by the smallest
    document, so that a copied document meets its copies in one; a shard with many copies is searched in several
    tasks, and one with many windows is held in parts.

    Defined cases: null and empty texts have no words; a row without id keeps its words and takes none from others;
    rows with the same id do not touch each other, so repeated rows have the same result; an empty table gives an
    empty one; a column that is called like an output gives way.
    """
    with_package(docs.sparkSession)
    gaps = repeated_stretches(docs, window, phrase, id_column, text_column)
    taken = {"n_words", "n_removed", "kept_text", text_column.lower()}
    keep = [c for c in docs.columns if c.lower() not in taken]
    row = F.struct(*[F.col(quoted(c)) for c in keep], F.lit(0).alias("__")).alias("row")
    rows = docs.select(row, F.col(quoted(id_column)).cast("bigint").alias("id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text")).join(_few(gaps), ["id", "text_hash"], "left")
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.select("row", "text", "gaps").mapInArrow(_finish, f"row {kind}, n_words bigint, n_removed bigint, kept_text string")
    columns: list[Column] = [F.col("row").getField(c).alias(c) for c in keep]
    return done.select(*columns, "n_words", "n_removed", "kept_text")
