"""Entropy-coded token files: static range asymmetric numeral system over shared frequencies."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import packed, staged, with_package
from segloom.llm.tokens import text_encoder
from segloom.llm.words import chunks

PRECISION = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MASK = np.uint64((1 << 32) - 1)
#: Symbols after which a block is closed, at the end of a document.
BLOCK = 1 << 16
#: Steps between two checkpoints.
STRIDE = 512
#: Blocks whose places in the whole are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
HEADER = struct.Struct("<4sIIHHII")
MAGIC = b"rANS"


@dataclass(frozen=True)
class Table:
    """Frequencies of all symbols, scaled to a power of two; every symbol that occurs has one at least."""

    scaled: np.ndarray
    start: np.ndarray
    symbol: np.ndarray
    mark: int

    @staticmethod
    def of(scaled: np.ndarray) -> Table:
        start = np.concatenate(([0], np.cumsum(scaled)[:-1])).astype(np.uint64)
        symbol = np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)
        # the mark does not depend on how many symbols beyond the last used one there are
        used = np.trim_zeros(scaled, "b").astype("<u4")
        return Table(scaled.astype(np.uint64), start, symbol, zlib.crc32(used))


def scale_counts(counts: np.ndarray) -> np.ndarray:
    """Counts as parts of 2^PRECISION, at least 1 where a symbol occurs."""
    total, room = int(counts.sum()), 1 << PRECISION
    if (counts > 0).sum() > room:
        raise ValueError(f"more than {room} symbols")
    if not total:
        return np.zeros(len(counts), np.int64)
    scaled = np.where(counts > 0, np.maximum(1, np.floor(counts / total * room)), 0).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    rest = room - int(scaled.sum())
    if rest >= 0:
        scaled[order[0]] += rest
    for k in order:  # too much was rounded up to 1: take it from the most frequent
        if rest >= 0:
            break
        take = min(-rest, int(scaled[k]) // 2)
        scaled[k] -= take
        rest += take
    return scaled


def lanes_of(symbols: int) -> int:
    """32 interleaved states, more for blocks that one long document makes."""
    lanes = 32
    while lanes < 4096 and symbols > lanes * 4096:
        lanes *= 2
    return lanes


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """The bytes of each block of symbols; blocks with as many lanes are encoded side by side."""
    out: list[bytes] = [b""] * len(blocks)
    by_lanes: dict[int, list[int]] = {}
    for k, block in enumerate(blocks):
        by_lanes.setdefault(lanes_of(len(block)), []).append(k)
    for lanes, members in by_lanes.items():
        members.sort(key=lambda k: -len(blocks[k]))
        for k, data in zip(members, _encode([blocks[k] for k in members], table, lanes)):
            out[k] = data
    return out


def _encode(blocks: list[np.ndarray], table: Table, lanes: int) -> list[bytes]:
    """``blocks`` from the longest to the shortest."""
    steps = [-(-len(b) // lanes) for b in blocks]
    most, many = steps[0], len(blocks)
    padded = np.zeros((most, many, lanes), dtype=np.uint32)
    for k, block in enumerate(blocks):
        filled = np.full(steps[k] * lanes, block[-1], dtype=np.uint32)
        filled[: len(block)] = block
        padded[: steps[k], k] = filled.reshape(steps[k], lanes)
    alive = np.searchsorted(-np.array(steps), -np.arange(most), side="left")
    state = np.full((many, lanes), LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    counts = np.zeros((most, many), dtype=np.int64)
    stops: dict[int, np.ndarray] = {}
    room = np.uint64(31 - PRECISION + 32)
    for t in range(most - 1, -1, -1):
        k = alive[t]
        symbol = padded[t, :k]
        x, f = state[:k], table.scaled[symbol]
        full = x >= (f << room)
        owner = np.nonzero(full)[0]
        words.append((x[full] & MASK).astype(np.uint32))
        owners.append(owner.astype(np.uint16))
        counts[t, :k] = np.bincount(owner, minlength=k)
        x = np.where(full, x >> WORD, x)
        whole = x // f
        state[:k] = (whole << np.uint64(PRECISION)) + (x - whole * f) + table.start[symbol]
        if t % STRIDE == 0:
            stops[t] = state.copy()
    stream, owner = np.concatenate(words[::-1]), np.concatenate(owners[::-1])
    stream = stream[np.argsort(owner, kind="stable")]
    ends = np.cumsum(counts.sum(0))
    before = np.cumsum(counts, 0) - counts
    out = []
    for k, block in enumerate(blocks):
        own = stream[ends[k] - counts[:, k].sum() : ends[k]]
        marks = range(0, steps[k], STRIDE)
        body = b"".join(
            struct.pack("<I", before[t, k]) + stops[t][k].astype("<u8").tobytes() for t in marks
        ) + own.astype("<u4").tobytes()
        head = HEADER.pack(MAGIC, table.mark, len(block), lanes, STRIDE, len(own), zlib.crc32(body))
        out.append(head + body)
    return out


def decode_blocks(blobs: list[bytes], table: Table) -> list[np.ndarray]:
    """The symbols of each block; all stretches between checkpoints are decoded side by side."""
    heads = [HEADER.unpack_from(b) for b in blobs]
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(blobs)
    for lanes in {h[3] for h in heads}:
        members = [k for k, h in enumerate(heads) if h[3] == lanes]
        for k, symbols in zip(members, _decode([blobs[k] for k in members], table, lanes)):
            out[k] = symbols
    return out


def _decode(blobs: list[bytes], table: Table, lanes: int) -> list[np.ndarray]:
    states, at, lengths, streams, sizes = [], [], [], [], []
    base = 0
    for blob in blobs:
        magic, mark, symbols, _, stride, words, check = HEADER.unpack_from(blob)
        body = memoryview(blob)[HEADER.size :]
        if magic != MAGIC or mark != table.mark or zlib.crc32(body) != check:
            raise ValueError("damaged block, or another frequency table")
        steps = -(-symbols // lanes)
        stops, width = -(-steps // stride), 4 + 8 * lanes
        for c in range(stops):
            (word,) = struct.unpack_from("<I", body, c * width)
            at.append(base + word)
            states.append(np.frombuffer(body, "<u8", lanes, c * width + 4))
            lengths.append(min(stride, steps - c * stride))
        streams.append(np.frombuffer(body, "<u4", words, stops * width))
        base += words
        sizes.append((symbols, steps))
    stream = np.append(np.concatenate(streams), np.uint32(0)).astype(np.uint64)
    order = np.argsort(-np.array(lengths), kind="stable")
    state, place = np.array(states, dtype=np.uint64)[order], np.array(at)[order]
    span = np.array(lengths)[order]
    most = int(span[0])
    alive = np.searchsorted(-span, -np.arange(most), side="left")
    symbols = np.zeros((len(span), most, lanes), dtype=np.uint32)
    low = np.uint64((1 << PRECISION) - 1)
    for t in range(most):
        k = alive[t]
        x = state[:k]
        slot = x & low
        found = table.symbol[slot]
        symbols[:k, t] = found
        x = table.scaled[found] * (x >> np.uint64(PRECISION)) + slot - table.start[found]
        short = x < LOW
        nth = np.cumsum(short, axis=1)
        words = stream[np.where(short, place[:k, None] + nth - 1, 0)]
        state[:k] = np.where(short, (x << WORD) | words, x)
        place[:k] += nth[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    out, first = [], 0
    for count, steps in sizes:
        own = []
        while steps > 0:
            length = lengths[first]
            own.append(symbols[back[first], :length].ravel())
            steps -= length
            first += 1
        out.append(np.concatenate(own)[:count])
    return out


def token_ids(docs: DataFrame, vocabulary: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """``part``, ``nth``, ``id`` and ``ids`` (little-endian bytes) of all documents; (part, nth) follows ascending id.

    After the documents of a part comes a row without ``nth``: its ``ids`` are how often each symbol occurs in the part,
    as pairs of 64-bit numbers.
    """
    with_package(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary)
        counts = np.zeros(max(encoder.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        nth, part = 0, 0
        for batch in chunks(batches):
            ids, ends = encoder.encode_all(batch.column("text").to_pylist())
            n = len(ends) - 1
            counts += np.bincount(ids, minlength=len(counts))
            counts[end_id] += n
            ids = np.insert(ids, ends[1:], end_id)
            places = (ends + np.arange(n + 1)) * encoder.width
            blobs = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(ids.tobytes())])
            arrays = [batch.column("part"), pa.array(np.arange(nth, nth + n)), batch.column("id"), blobs.cast(pa.binary())]
            part, nth = batch.column("part")[0].as_py(), nth + n
            yield pa.RecordBatch.from_arrays(arrays, ["part", "nth", "id", "ids"])
        if nth:
            used = np.nonzero(counts)[0]
            pairs = np.stack((used, counts[used]), 1).astype("<i8").tobytes()
            last = [pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([pairs], pa.binary())]
            yield pa.RecordBatch.from_arrays(last, ["part", "nth", "id", "ids"])

    rows = packed(docs, id_column, text_column).select("id", "text", F.xxhash64("text").alias("text_hash"))
    ordered = rows.repartitionByRange("id", "text_hash").sortWithinPartitions("id", "text_hash")
    ordered = ordered.select(F.spark_partition_id().alias("part"), "id", "text")
    return ordered.mapInArrow(encode, "part int, nth bigint, id bigint, ids binary")


def symbol_counts(ids: DataFrame, symbols: int) -> np.ndarray:
    """How often each symbol occurs, from the parts' counts. One number per symbol is collected."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column("ids").to_pylist():
                found = np.frombuffer(pairs, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["symbol", "n"])

    rows = ids.where("nth is null").select("ids").mapInArrow(spread, "symbol bigint, n bigint").groupBy("symbol").agg(F.sum("n").alias("n"))
    counts = np.zeros(symbols, np.int64)
    for row in rows.collect():
        counts[row.symbol] = row.n
    return counts


BLOCKS = "part int, first bigint, symbols bigint, ids array<bigint>, lengths array<bigint>, data binary"
#: Symbols that are encoded, or bytes that are decoded, side by side.
AT_ONCE = 64 * BLOCK


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Writes the token ids of all documents, each followed by ``end_id``, in ascending order of id.

    ``path/frequencies`` has the shared table of symbol frequencies, counted over all documents;
    ``path/blocks`` has one row per block: its place (``part``, ``first``), the ids and lengths of
    its documents, and ``data``, the encoded symbols. A block holds whole documents, about 65,536
    symbols or one longer document, and can be decoded alone: the header names the frequency
    table, a checksum covers the body, symbols are interleaved over 32 or more states, and every
    ``STRIDE`` steps a checkpoint keeps the states and the place in the stream.

    Documents are put in order by a range exchange of the texts; the ids are kept in the shared
    folder between counting and encoding. Null and empty texts have the end id alone; repeated rows
    are kept, rows without id come first; an empty table gives empty files.
    """
    spark = docs.sparkSession
    encoder = text_encoder(vocabulary)
    symbols, kind = max(encoder.tokenizer.get_vocab_size(), end_id + 1), f"<u{encoder.width}"
    ids = staged(token_ids(docs, vocabulary, end_id, id_column, text_column), "token-ids")
    scaled = scale_counts(symbol_counts(ids, symbols)).astype(np.uint32)
    spark.createDataFrame(
        [(s, int(n)) for s, n in enumerate(scaled) if n], "symbol int, frequency int"
    ).coalesce(1).write.parquet(f"{path}/frequencies")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(scaled)
        ready: list[tuple[int, int, list, list, bytes]] = []
        place, names, parts, size, pending = (0, 0), [], [], 0, 0

        def close() -> None:
            if names:
                ready.append((*place, list(names), [len(p) // width for p in parts], b"".join(parts)))
                names.clear()
                parts.clear()

        def flush() -> pa.RecordBatch:
            data = encode_blocks([np.frombuffer(r[4], kind) for r in ready], table)
            rows = [(p, f, sum(n), i, n, d) for (p, f, i, n, _), d in zip(ready, data)]
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], BLOCK_NAMES)

        width = np.dtype(kind).itemsize
        types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for part, nth, doc, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "nth", "id", "ids"))):
                if names and (part != place[0] or nth != place[1] + len(names)):
                    close()
                if not names:
                    place, size = (part, nth), 0
                names.append(doc)
                parts.append(blob)
                size += len(blob) // width
                pending += len(blob) // width
                if size >= BLOCK:
                    close()
                if pending >= AT_ONCE:
                    close()
                    yield flush()
                    pending = 0
        close()
        if ready:
            yield flush()

    ids.where("nth is not null").mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


BLOCK_NAMES = [field.split()[0] for field in BLOCKS.split(", ")]


def read_token_files(spark, path: str, with_ids: bool = True) -> DataFrame:
    """What ``write_token_files`` wrote: ``id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) and, on request, ``ids``.

    Blocks are decoded where they are read. The start of a block comes from running sums over blocks of
    a part and over parts, so no task sees more than one row per part.
    """
    with_package(spark)
    table_rows = spark.read.parquet(f"{path}/frequencies").collect()
    scaled = np.zeros(max((r.symbol for r in table_rows), default=-1) + 1, np.uint32)
    for row in table_rows:
        scaled[row.symbol] = row.frequency

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.of(scaled)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "first", "ids", "lengths", "data")]
            rows = list(zip(*columns))
            while rows:
                some, size = [], 0
                while rows and (not some or size < 2 * AT_ONCE):
                    some.append(rows.pop(0))
                    size += 2 * sum(some[-1][3])
                yield _documents(some, table, with_ids)

    schema = "part int, first bigint, skip bigint, id bigint, n_tokens bigint, ids_crc32 bigint"
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(decode, schema + (", ids array<int>" if with_ids else ""))
    sizes = blocks.select("part", "first", "symbols")
    earlier = (Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("symbols").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    own = F.coalesce(F.sum("symbols").over(Window.partitionBy("part").orderBy("first").rowsBetween(*earlier)), F.lit(0))
    starts = sizes.select("part", "first", own.alias("offset")).join(parts, "part")
    starts = starts.select("part", "first", (F.col("base") + F.col("offset")).alias("base"))
    if blocks.count() <= BROADCAST_ROWS:  # a row for each 65,536 ids: then documents need not be moved
        starts = F.broadcast(starts)
    return docs.join(starts, ["part", "first"]).select(
        "id",
        (F.col("base") + F.col("skip")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def _documents(blocks: list[tuple], table: Table, with_ids: bool) -> pa.RecordBatch:
    rows, ids = [], []
    for (part, first, names, lengths, _), symbols in zip(blocks, decode_blocks([b[4] for b in blocks], table)):
        at, symbols = 0, symbols.astype("<u4")
        for name, length in zip(names, lengths):
            own = symbols[at : at + length]
            rows.append((part, first, at, name, length, zlib.crc32(own)))
            if with_ids:
                ids.append(own)
            at += length
    types = [pa.int32(), *[pa.int64()] * 5]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    labels = ["part", "first", "skip", "id", "n_tokens", "ids_crc32"]
    if with_ids:
        offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).view("<i4"))))
        labels.append("ids")
    return pa.RecordBatch.from_arrays(arrays, labels)
