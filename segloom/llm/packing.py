"""Best-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import packed, staged, with_package
from segloom.llm.tokens import text_encoder
from segloom.llm.words import chunks

#: Pieces that one packing task places; more pieces make more tasks.
PIECES_PER_TASK = 30_000

#: Pieces whose places are broadcast; the places of more are brought to their pieces by a shuffle.
BROADCAST_ROWS = 500_000

PIECES = "uid bigint, id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_column: str, text_column: str, with_ids: bool) -> DataFrame:
    """One row per piece of at most ``capacity`` ids of a document and its end id."""
    with_package(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(vocabulary)
        uid = TaskContext.get().partitionId() << 40
        for batch in chunks(batches):
            rows, ids = [], []
            tokens, ends = encoder.encode_all(batch.column("text").to_pylist())
            tokens = np.insert(tokens, ends[1:], end_id).astype("<u4")
            ends = (ends + np.arange(len(ends))).tolist()
            for doc, first, end in zip(batch.column("id").to_pylist(), ends, ends[1:]):
                for piece, at in enumerate(range(first, end, capacity)):
                    part = tokens[at : min(at + capacity, end)]
                    rows.append((uid, doc, piece, at - first, len(part), zlib.crc32(part)))
                    uid += 1
                    if with_ids:
                        ids.append(part.tobytes())
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            names = ["uid", "id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = packed(docs, id_column, text_column).select("id", "text")
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, placed in the given order.

    ``open_bins[g]`` is the number of open bins with ``g`` places left. A piece goes where the sum
    of the squares of these numbers becomes smallest: into an open bin or a new one, the
    tightest among equals. A bin that is exactly full is closed.
    """
    open_bins = np.zeros(capacity, dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    never = np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        if size >= capacity:
            bins[k], offsets[k] = opened, 0
            opened += 1
            continue
        # change of the sum of squares if a bin with gap size, size + 1, ... takes the piece
        here = open_bins[size:]
        change = 2 * (open_bins[: capacity - size] - here) + 2
        change[0] = 1 - 2 * here[0]
        change[here == 0] = never
        gap = int(change.argmin()) if len(change) else 0
        best = change[gap] if len(change) else never
        gap += size
        if 2 * open_bins[capacity - size] + 1 < best:
            number, gap = opened, capacity
            opened += 1
        else:
            number = waiting[gap].pop()
            open_bins[gap] -= 1
        bins[k], offsets[k] = number, capacity - gap
        if gap > size:
            open_bins[gap - size] += 1
            waiting[gap - size].append(number)
    return bins, offsets


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Token pieces with their place in sequences of at most ``capacity`` ids.

    A document is its text's ids and ``end_id``; longer ones are cut into pieces of ``capacity``,
    the last may be shorter. Returns per piece ``id``, ``piece``, ``start`` (the document's ids
    before it), ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and, on request, ``ids``
    (little-endian unsigned 32-bit numbers).

    Full pieces are sequences of their own. The others, one per document, are dealt at random to
    tasks of about ``PIECES_PER_TASK``, and each task packs its share by ``sum_of_squares``, longest
    first. Only ids and lengths are moved for it. A share wastes a bin or two at its end, a
    ten-thousandth of its places, whatever the size of the table.

    Defined cases: null and empty texts are one piece with the end id alone; a row without id keeps
    its place like any other; repeated rows are packed once each; an empty table gives an empty
    table. Other columns do not matter.
    """
    pieces = staged(token_pieces(docs, vocabulary, capacity, end_id, id_column, text_column, with_ids), "pieces")
    partial = pieces.where(F.col("length") < capacity).select("uid", "length")
    partial_rows = partial.count()
    shares = max(1, -(-partial_rows // PIECES_PER_TASK))

    def place(share: pd.DataFrame) -> pd.DataFrame:
        share = share.sort_values(["length", "uid"], ascending=[False, True])
        bins, offsets = sum_of_squares(share["length"].to_numpy(), capacity)
        number = (share["share"].to_numpy() << 32) + bins
        return pd.DataFrame({"uid": share["uid"], "sequence_id": number, "offset": offsets})

    share = F.pmod(F.xxhash64("uid"), F.lit(shares)).alias("share")
    placed = partial.select("uid", "length", share).groupBy("share").applyInPandas(
        place, "uid bigint, sequence_id bigint, offset bigint"
    )
    if partial_rows <= BROADCAST_ROWS:  # a few numbers each: then the pieces' ids need not be moved
        placed = F.broadcast(staged(placed, "places"))
    return pieces.join(placed, "uid", "left").select(
        "id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("sequence_id", -F.col("uid") - 1).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("bigint")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
