"""Token ids, counts, packing and token files against the tokenizers library."""

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from segloom.llm import tokens
from segloom.llm.packing import pack_documents, sum_of_squares
from segloom.llm.rans import Table, decode_blocks, encode_blocks, read_token_files, scale_counts, write_token_files
from segloom.llm.token_count import TokenCounter, count_tokens
from segloom.llm.tokens import LAST_LATIN, PLAIN_PIECE, TextEncoder, plain_words
from segloom.session import fresh_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "a  b", "a   b ", "\n\na\n", "x\ty \t z", "it's I'LL we'd", "<|endoftext|> a  <|startoftext|>", "é é", "ΑΣ Σ",
    "İstanbul", "a\x1cb", "\x00", "a\xa0b \xa0c", "½ 12", "日本語", "👨‍👩‍👧", "ﬁ", "!!! ...", "a\r\nb", "word, word; (word)", "ñ" * 300,
]


def latin_texts():
    """Plain pieces of every kind, with all Latin letters and marks."""
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x21, 0x250) if chr(c).isprintable()]
    words = ["".join(rng.choice(letters if rng.random() < 0.5 else letters[:94]) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    words += ["it's", "I'LL", "we'd've", "word,", "(word)", "2024-05", "x²", "1½", "İx", "ŉ", "ǰa"]
    return [" ".join(rng.choices(words, k=30)).replace(words[7], "\n") for _ in range(300)] + ["\n".join(words[:200])]


def odd_texts():
    rng = random.Random(5)
    return ODD + ["".join(rng.choice(" \n\tab'sLé́Σ!?\xa0 -日1") for _ in range(rng.randrange(40))) for _ in range(800)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_as_the_library_gives_them(path):
    library, own = Tokenizer.from_file(path), TextEncoder(path)
    for text in odd_texts() * 2:
        assert list(memoryview(own.encode(text)).cast(own.code)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_of_many_texts_at_once(path, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 50)
    library, own = Tokenizer.from_file(path), TextEncoder(path)
    texts = odd_texts() + latin_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for size in (1, 7, 1000):
        for k in range(0, len(texts) if size > 1 else 60, size):
            ids, ends = own.encode_all(texts[k : k + size])
            assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want[k : k + size]
    assert [a.tolist() for a in own.encode_all([])] == [[], [0]]


class CountingModel:
    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, word):
        self.calls += 1
        return self.model.tokenize(word)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_a_full_memory_keeps_the_words_at_hand(path, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 300)
    library, own = Tokenizer.from_file(path), TextEncoder(path)
    own.model = CountingModel(own.model)
    words = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in "nrstvwxz"]
    often, later = [f"x {' '.join(words[:160])}", "日本 語"], [f"x {' '.join(words[160:])} 本日"]
    own.encode_all([" ".join(w + "q" for w in words[:100])])
    own.encode_all(often)
    own.encode_all(often + later)  # more than it holds, with those it had
    calls, held = own.model.calls, len(own.known)
    ids, ends = own.encode_all(often + later)
    assert own.model.calls == calls and 280 < held <= len(own.sizes) <= 300 and len(own.flat) == own.sizes.sum()
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [e.ids for e in library.encode_batch(often + later, add_special_tokens=False)]
    long = ["y" * 5000 + " " + "日" * 5000]
    own.encode_all(long)
    assert len(own.flat) == own.sizes.sum() < 2000  # long ones are not held


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_plain_words_as_the_pattern_has_them(path):
    rng, own = random.Random(7), TextEncoder(path)
    alone = own.drops_space
    letters = pa.array(map(chr, range(0x21, ord(LAST_LATIN) + 1)))
    letters = [c for c in letters.filter(pc.match_substring_regex(letters, PLAIN_PIECE)).to_pylist() if c != "'"]
    letters += ["²", "½", "7", "a", "é"] * 20
    pieces = [a + b for a in letters[:420] for b in ".a1é²"] + ["".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(3000)]
    if not alone:
        pieces = [rng.choice(["", " ", "\n"]) + p for p in pieces]
    found, many = plain_words(pa.array(pieces).slice(3), alone)
    found, ends = found.to_pylist(), np.cumsum(many).tolist()
    assert [found[a:b] for a, b in zip([0, *ends], ends)] == [own.split.findall(p) for p in pieces[3:]]
    assert plain_words(pa.array([], pa.string()), alone)[0].to_pylist() == []


def test_words_of_another_pattern(tmp_path):
    with open(WORDS, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    assert split["pattern"]["Regex"] == tokens.DIGITS_ALONE
    split["pattern"]["Regex"] = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    library, own = Tokenizer.from_file(str(path)), TextEncoder(str(path))
    texts = ["a12345b it's... 7 2024-05!!", *latin_texts()[:20]]
    ids, ends = own.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_all_letters():
    library, own = Tokenizer.from_file(WORDS), TokenCounter(WORDS)
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    found = library.encode_batch_fast(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, found) if own.count(t) != len(e.ids)] == []


def test_counts_as_the_library_gives_them():
    library, own = Tokenizer.from_file(WORDS), TokenCounter(WORDS)
    for text in odd_texts() * 2:
        assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_columns(spark):
    df = spark.createDataFrame([(1, "hello world", 5), (1, "hello world", 5), (None, None, 6)], "doc_id bigint, text string, N_TOKENS int")
    rows = count_tokens(df, WORDS, limit=1)
    assert rows.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, rows.fillna(-1).collect())) == [(-1, 0, 0, False), (1, 11, 2, True), (1, 11, 2, True)]
    assert count_tokens(df.limit(0), WORDS).count() == 0


def test_sum_of_squares_places_as_defined():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 21, 300)
    bins, offsets = sum_of_squares(sizes, 20)
    open_bins: dict[int, int] = {}
    for size, b in zip(sizes.tolist(), bins.tolist()):
        def cost(target):
            gaps = {**open_bins, target: open_bins.get(target, 20) - size}
            counts = np.bincount([g for g in gaps.values() if g], minlength=21)
            return int((counts**2).sum())

        options = [k for k, g in open_bins.items() if g >= size] + [max(open_bins, default=-1) + 1]
        assert cost(b) == min(map(cost, options))
        open_bins[b] = open_bins.get(b, 20) - size
    assert min(open_bins.values()) >= 0


def test_packing(spark, data):
    texts = [None, "", "word " * 9000, *(f"text {'and more ' * k}" for k in range(300)), "same", "same"]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id bigint, text string, piece int")
    rows = pack_documents(df, WORDS).toPandas()
    library = Tokenizer.from_file(WORDS)
    for doc, part in rows.sort_values(["id", "piece"]).groupby("id"):
        ids = np.array(library.encode(texts[doc] or "", add_special_tokens=False).ids + [1], "<u4")
        assert np.array_equal(np.frombuffer(b"".join(part.ids), "<u4"), ids)
        assert list(part.start) == list(range(0, len(ids), 4096)) and set(part.length[:-1]) <= {4096}
        assert [zlib.crc32(ids[a : a + n]) for a, n in zip(part.start, part.length)] == list(part.ids_crc32)
    rows = rows.sort_values(["sequence_id", "offset"])
    filled = rows.groupby("sequence_id").length
    assert (rows.offset == filled.cumsum() - rows.length).all() and filled.sum().max() <= 4096
    assert filled.ngroups <= -(-rows.length.sum() // 4096) + 1
    assert pack_documents(df.limit(0), WORDS).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.zipf(1.3, n).clip(max=5000).astype(np.uint16) for n in (1, 31, 32, 33, 70_000, 300_000)]
    blocks.append(np.zeros(5000, np.uint16))
    counts = sum(np.bincount(b, minlength=6000) for b in blocks)
    table = Table.of(scale_counts(counts))
    blobs = encode_blocks(blocks, table)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, decode_blocks(blobs, table)))
    entropy = -sum(n * np.log2(n / counts.sum()) for n in counts if n) / 8
    assert sum(map(len, blobs)) < 1.05 * entropy + 4000
    with pytest.raises(ValueError):
        decode_blocks([blobs[4][:-3] + b"abc"], table)
    only = Table.of(scale_counts(np.array([0, 9])))
    assert decode_blocks(encode_blocks([np.ones(100, np.uint16)], only), only)[0].tolist() == [1] * 100


def test_token_files(spark):
    texts = [*odd_texts()[:60], None, "same", "same", "long " * 90_000]
    ids = [*range(100, 160), 3, 7, 7, 50]
    df = spark.createDataFrame(list(zip(ids, texts, ids)), "doc_id bigint, text string, part bigint").repartition(5)
    path = fresh_path(spark, "token-files")
    write_token_files(df, path, BYTES)
    library, start = Tokenizer.from_file(BYTES), 0
    rows = read_token_files(spark, path).orderBy("start").collect()
    assert [r.id for r in rows] == sorted(ids)
    by_id = dict(zip(ids, texts))
    for row in rows:
        want = library.encode(by_id[row.id] or "", add_special_tokens=False).ids + [0]
        assert row.ids == want and row.start == start and row.ids_crc32 == zlib.crc32(np.array(want, "<u4"))
        start += len(want)
    empty = fresh_path(spark, "token-files")
    write_token_files(df.limit(0), empty, BYTES)
    assert read_token_files(spark, empty).count() == 0
