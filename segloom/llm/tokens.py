"""Token ids of whole texts, with each distinct piece of text encoded once per worker."""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Entries of a worker's memory of words (and of pieces, for counts), each of at most ``LONGEST_KNOWN`` characters: some
#: 100 MB, 200 MB at the very most. A full one starts anew; that of ids with the words at hand.
KNOWN_PIECES = 300_000
KNOWN_WORDS = 400_000
LONGEST_KNOWN = 64

#: White space besides the blank and the line feed, as Unicode has it.
OTHER_SPACE = [*"\t\x0b\x0c\r\x85\xa0     　", *map(chr, range(0x2000, 0x200B))]
#: Characters that Python calls white space and tokenizers do not.
SEPARATORS = [*"\x1c\x1d\x1e\x1f"]


#: Fixed value: the last letter of Latin Extended-B.
LAST_LATIN = "\u024f"
#: Fixed value: the words of byte-level vocabularies.
BYTE_LEVEL_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the words of lower-case vocabularies that drop white space, each digit alone.
DIGITS_ALONE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What lies between pieces that are split together; no plain piece has it.
BETWEEN = "\r"
#: Pieces of Latin letters, digits and marks (one blank or line feed before them), which all versions of Unicode and of
#: the library split alike.
PLAIN_PIECE = r"^[ \n]?[!-~\x{a1}-\x{ac}\x{ae}-\x{24f}]+$"
#: Plain pieces without blanks, and without letters that lower case or composition makes longer.
PLAIN_WORDS = r"^[!-~\x{c0}-\x{12f}\x{131}-\x{24f}]+$"
#: Kinds of plain characters: the blank, letters, digits, other marks, the line feed. Words end where the kind changes.
BLANK, LETTER, DIGIT, MARK, FEED = range(5)
#: Marks that often end a word; a run of them is a token run of its own after letters.
TAIL = ".,;:!?|%*$#&"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def plain_kinds() -> np.ndarray:
    """The kind of each character up to ``LAST_LATIN``."""
    kinds = np.full(ord(LAST_LATIN) + 1, MARK, np.uint8)
    for c in map(chr, range(len(kinds))):
        if regex.match(r"[\p{L}\p{N}]", c):
            kinds[ord(c)] = LETTER if regex.match(r"\p{L}", c) else DIGIT
    kinds[[ord(" "), ord("\n")]] = BLANK, FEED
    return kinds


KINDS = plain_kinds()


def plain_words(pieces: pa.Array, digits_alone: bool) -> tuple[pa.Array, np.ndarray]:
    """The words of plain pieces without apostrophes in a row, and how many each piece has.

    A word is a run of characters of one kind with the blank before it, or one digit if ``digits_alone``.
    """
    if not len(pieces):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    ends = np.frombuffer(pieces.buffers()[1], "<i4")[pieces.offset : pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    first = np.flatnonzero(data >= 0xC0)  # of the two bytes of a character beyond ASCII
    code = data.astype(np.uint16)
    code[first] = (code[first] & 0x1F) << 6 | (code[first + 1] & 0x3F)
    code[first + 1] = code[first]
    kind = KINDS[code]
    begins = np.empty(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != BLANK)
    if digits_alone:
        begins |= kind == DIGIT
        begins[first + 1] = False
    begins[ends[:-1] - ends[0]] = True
    places = np.append(np.flatnonzero(begins), len(data))
    words = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype("<i4")), pa.py_buffer(data))
    return words, np.diff(np.searchsorted(places, ends - ends[0]))


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


class TextEncoder:
    """Ids by the tokenizers library, pieced together from texts' cut-out pieces.

    A text is cut only where no token can cross, so that a piece has the same ids alone as in its
    text. With a tokenizer that drops white space that is any blank or line feed. With a
    byte-level one, a blank belongs to the word after it: a cut goes before a blank or line feed,
    and texts with runs of white space are cut before each run. Plain pieces are split into words as the library
    does, and its model gets each new word; other pieces go to the library. Texts that hold a special
    token's string, or a character that could be taken for white space by one side only, go to
    the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.code = "I" if self.wide else "H"
        kind = str(self.tokenizer.pre_tokenizer.__getstate__())
        self.drops_space = '"behavior":"Removed"' in kind or "behavior: Removed" in kind
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.letters = byte_letters() if type(self.model).__name__ == "BPE" and "ByteLevel" in kind else None
        self.split = self._word_pattern(path) if self.letters else None
        self.known: dict[str, int] = {}  # places in sizes
        self.flat, self.sizes = np.zeros(0, f"<u{self.width}"), np.zeros(0, np.int64)

    def _word_pattern(self, path: str) -> regex.Pattern | None:
        """What the library takes for words, and the mark between pieces; None if its steps are not those known here."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first = (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])[0]
        if self.drops_space:
            steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
            known = steps == ["NFC", "Replace", "Lowercase"] and first["type"] == "Split"
            return regex.compile(f"{first['pattern']['Regex']}|{BETWEEN}") if known else None
        plain = spec["normalizer"] is None and first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        return regex.compile(BYTE_LEVEL_WORDS) if plain else None

    @property
    def width(self) -> int:
        return 4 if self.wide else 2

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned numbers of ``width`` bytes."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids begin (one more than texts).

        Pieces are cut and told apart for all texts at once, so that each distinct one is worked on once.
        """
        marked, alone = [], {}
        for k, text in enumerate(texts):
            line = self._marked(text)
            if line is None:  # for the library as a whole
                alone[k] = self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
                line = ""
            marked.append(line)
        lists = pc.split_pattern(pa.array(marked, pa.string()), " " if self.drops_space else "\0")
        ends = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.dictionary_encode()
        slots, flat, sizes = self._piece_ids(pieces.dictionary, list(alone.values()))
        codes = slots[pieces.indices.to_numpy()]
        for n, k in enumerate(alone):
            codes[ends[k]] = len(slots) + n
        ids, after = gathered(flat, sizes, codes)
        return ids, after[ends]

    def _piece_ids(self, pieces: pa.Array, more: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each piece's place among all, and the ids of all in that order with their numbers; ``more`` come last."""
        plain, quoted = np.zeros((2, len(pieces)), bool)
        if self.split:
            plain = pc.match_substring_regex(pieces, PLAIN_WORDS if self.drops_space else PLAIN_PIECE).to_numpy(zero_copy_only=False)
            by_kind = self.split.pattern.startswith((DIGITS_ALONE + "|" + BETWEEN, BYTE_LEVEL_WORDS))
            quoted = plain & pc.match_substring(pieces, "'" if by_kind else "").to_numpy(zero_copy_only=False)
            plain = plain & ~quoted
        other = ~(plain | quoted)
        slots = np.empty(len(pieces), np.int64)
        slots[np.concatenate([np.flatnonzero(kind) for kind in (plain, quoted, other)])] = np.arange(len(pieces))
        words, many = plain_words(pieces.filter(pa.array(plain)), self.drops_space)
        several = strings(pieces.filter(pa.array(quoted)))
        if several:  # what an apostrophe begins depends on what is before it
            line = BETWEEN.join([*several, ""])
            found = pa.array(self.split.findall(line.lower() if self.drops_space else line), pa.string())
            between = pc.equal(found, BETWEEN)
            many = np.concatenate((many, np.diff(np.flatnonzero(between.to_numpy(zero_copy_only=False)), prepend=-1) - 1))
            words = pa.concat_arrays([words, found.filter(pc.invert(between))])
        words = words.dictionary_encode()
        distinct = strings(words.dictionary)
        if self.drops_space:
            distinct = [w.lower() for w in distinct]
        flat, sizes, places = self._places(distinct, strings(pieces.filter(pa.array(other))))
        codes = np.concatenate((places[: len(distinct)][words.indices.to_numpy()], places[len(distinct) :]))
        flat, after = gathered(flat, sizes, codes)
        upto = np.cumsum(np.concatenate((many, np.ones(len(codes) - len(words), np.int64))))
        sizes = np.diff(after[np.concatenate(([0], upto))])
        flat = np.concatenate((flat, np.frombuffer(b"".join(more), flat.dtype)))
        return slots, flat, np.concatenate((sizes, np.fromiter(map(len, more), np.int64, len(more)) // self.width))

    def _places(self, words: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their numbers, and each text's place among them: words (for the library's model), then pieces (for the library)."""
        texts = [*words, *others]
        places = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(places < 0)
        if not len(new):
            return self.flat, self.sizes, places
        ids, many = array(self.code), []
        letters, tokenize = self.letters, self.model.tokenize
        for k in new[: np.searchsorted(new, len(words))].tolist():
            word = texts[k]
            plain = word.isascii() and word.isprintable()
            found = tokenize(word.replace(" ", letters[32]) if plain else "".join([letters[b] for b in word.encode()]))
            ids.extend([t.id for t in found])
            many.append(len(found))
        pieces = [texts[k] for k in new[len(many) :].tolist()]
        for found in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False):
            ids.extend(found.ids)
            many.append(len(found.ids))
        flat = np.concatenate((self.flat, np.frombuffer(ids, self.flat.dtype)))
        sizes = np.concatenate((self.sizes, np.array(many, np.int64)))
        places[new] = np.arange(len(self.sizes), len(sizes))
        if len(sizes) > KNOWN_WORDS:
            self.known, self.flat, self.sizes = {}, self.flat[:0], self.sizes[:0]
            new = np.arange(len(texts))
        kept = [k for k in new.tolist() if len(texts[k]) <= LONGEST_KNOWN][:KNOWN_WORDS]
        held = places[kept]
        self.known.update(zip([texts[k] for k in kept], range(len(self.sizes), len(self.sizes) + len(kept))))
        self.flat = np.concatenate((self.flat, gathered(flat, sizes, held)[0]))
        self.sizes = np.concatenate((self.sizes, sizes[held]))
        return flat, sizes, places

    def _marked(self, text: str) -> str | None:
        """The text with a mark where it is cut; None if it has to be encoded as a whole."""
        if any(s in text for s in self.specials):
            return None
        if self.drops_space:
            return text.replace("\n", " ")
        if "\0" in text or any(c in text for c in SEPARATORS):
            return None
        runs = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
        if runs or text[-1:] in (" ", "\n") or any(c in text for c in OTHER_SPACE):
            return "\0".join(re.findall(r"\s*\S+|\s+", text))
        return text.replace(" ", "\0 ").replace("\n", "\0\n")

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()


def gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` (of ``sizes``) that ``codes`` name, in a row, and where each begins (one more)."""
    many = sizes[codes]
    after = np.concatenate(([0], np.cumsum(many)))
    places = np.repeat((np.cumsum(sizes) - sizes)[codes] - after[:-1], many) + np.arange(after[-1])
    return flat[places], after


@functools.lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One per worker process and vocabulary."""
    return TextEncoder(path)
