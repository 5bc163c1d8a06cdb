"""Token counts by byte-pair merging, without identifiers."""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import packed, unpacked, with_package
from segloom.llm.tokens import KNOWN_PIECES, KNOWN_WORDS, LONGEST_KNOWN, TAIL, byte_letters


#: Letters whose lower form the tokenizers library knows and this Python does not; sigma, which the
#: library lowers letter by letter, not by its place in the word.
LOWER = {0x03A3: 0x03C3, 0xA7CB: 0x0264, 0xA7DC: 0x019B}


class TokenCounter:
    """Counts the tokens of a text under a byte-level merge list with word ends.

    Reads a tokenizer's JSON file: the merge list, the pattern of words, the suffix of a word's
    last symbol and the special strings. Texts are put in NFC and lower case.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizer {steps}")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.word = regex.compile(split["pattern"]["Regex"])
        specials = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(specials)) if specials else None
        self.marks = [t["content"] for t in spec["added_tokens"]]
        vocabulary, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = [vocabulary.get(c) for c in letters]
        self.last = [vocabulary.get(c + suffix) for c in letters]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def count(self, text: str) -> int:
        if self.special and any(m in text for m in self.marks):
            found = len(self.special.findall(text))
            return found + sum(self._count_plain(part) for part in self.special.split(text))
        return self._count_plain(text)

    def _count_plain(self, text: str) -> int:
        # no word crosses a blank or a line feed, nor does a composed character
        pieces = text.replace("\n", " ").split(" ")
        counts = list(map(self.pieces.get, pieces))
        if None in counts:
            if len(self.pieces) > KNOWN_PIECES:
                self.pieces = {}
            counts = [self._piece(p) if n is None else n for p, n in zip(pieces, counts)]
        return sum(counts)

    def _piece(self, piece: str) -> int:
        word = piece.rstrip(TAIL)
        if word.isalpha() and word.isascii():
            tail = piece[len(word) :]
            total = self._word(word.lower()) + (self._word(tail) if tail else 0)
            if len(piece) <= LONGEST_KNOWN:
                self.pieces[piece] = total
            return total
        plain = unicodedata.normalize("NFC", piece).translate(LOWER).lower()
        total = sum(map(self._word, self.word.findall(plain)))
        if len(piece) <= LONGEST_KNOWN:
            self.pieces[piece] = total
        return total

    def _word(self, word: str) -> int:
        total = self.words.get(word)
        if total is None:
            octets = word.encode()
            symbols = [self.inner[b] for b in octets[:-1]] + [self.last[octets[-1]]]
            symbols = [s for s in symbols if s is not None]
            total = len(symbols) - self.merges(symbols)
            if len(word) <= LONGEST_KNOWN:
                if len(self.words) > KNOWN_WORDS:
                    self.words = {}
                self.words[word] = total
        return total

    def merges(self, symbols: list[int]) -> int:
        """How many merges a word takes.

        The symbols are a linked list; a heap holds the adjacent pairs that can merge. The pair
        of lowest rank goes first, the leftmost among equals; entries whose pair has changed since
        are passed over.
        """
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (*rank[pair], i, *pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in rank
        ]
        heap = [(r, i, new, left, right) for r, new, i, left, right in heap]
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, new, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            done += 1
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (pair := (symbols[a], symbols[b])) in rank:
                    r, made = rank[pair]
                    heapq.heappush(heap, (r, a, made, *pair))
        return done


@functools.lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    """One per worker process and vocabulary."""
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All columns of ``docs`` except the text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``vocabulary`` is the path of a tokenizer file, readable on every executor. Each text is
    counted where it is read; nothing is shuffled. A word's count is its symbols minus its merges,
    remembered per worker for a bounded number of words.

    Defined cases: null and empty texts have 0 bytes and 0 tokens; special strings inside a text
    count as one token each; repeated rows are counted alike; an empty table gives an empty one.
    """
    with_package(docs.sparkSession)
    rows = packed(docs, id_column, text_column)
    keep = [f.name for f in docs.schema.fields if f.name.lower() != text_column.lower()]
    slim = rows.select(F.struct(*[F.col("row").getField(k).alias(k) for k in keep]).alias("row"), "text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(vocabulary)
        for batch in batches:
            counts = pa.array([counter.count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n_bytes"), counts], ["row", "n_bytes", "n_tokens"])

    sized = slim.select("row", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    schema = slim.select("row", F.lit(0).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_tokens")).schema
    counted = sized.mapInArrow(add, schema).withColumn("over_limit", F.col("n_tokens") > limit)
    return unpacked(counted, "n_bytes", "n_tokens", "over_limit")
