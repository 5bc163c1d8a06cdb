"""Words of texts as Arrow arrays and codes, for operators that work on whole chunks of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 6_000_000


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for k, n in enumerate(lengths.tolist()):
            if held and held + n > size:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in a row, and where each text's words begin (one more than texts)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    places = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    ends = np.concatenate(([0], np.cumsum(filled, dtype=np.int64)))[places]
    return flat.filter(pa.array(filled)), ends


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Equal codes for equal words, from 0, and the word of each code."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def list_array(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def joined(words: pa.Array, ends: np.ndarray) -> pa.Array:
    """Each text's words with one blank between them."""
    return pc.binary_join(list_array(ends, words), " ")


MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mixed(values: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    values = values.astype(np.uint64)
    for factor in MIX:
        values = values ^ (values >> np.uint64(33))
        values = values * factor
    return values ^ (values >> np.uint64(33))


def rolling(values: np.ndarray, width: int, factor: np.uint64) -> np.ndarray:
    """A hash of each ``width`` neighbours; the last ones stay as they are, short of neighbours."""
    out = values.copy()
    for k in range(1, width):
        out[: len(out) - k] = out[: len(out) - k] * factor + values[k:]
    return out
