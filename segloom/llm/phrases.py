"""Phrases whose words come together more often than their parts: count streams in prefix and in suffix order, merged."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import ASCII_LOWER, ASCII_UPPER, quoted, staged, text_or_empty, with_package
from segloom.llm.words import chunks, mixed

#: Words of the longest phrase, and occurrences of a candidate at least.
LONGEST = 5
LEAST = 100
#: Phrases reported for each language.
TOP = 2_000
#: Marks and line ends that no phrase crosses.
BREAKS = ".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans((ASCII_UPPER + BREAKS).encode(), (ASCII_LOWER + "." * len(BREAKS)).encode())
#: Bytes of text whose windows are counted together before they are sent.
CHUNK = 16_000_000
#: Counters of word pairs. They only spare windows; nothing depends on their number.
SLOTS = 1 << 22
BLOCK = 1 << 16
#: Sampled windows, of a chunk and in all, that the ranges of the exchange are cut by, and windows of a range.
SAMPLED = 200
SAMPLE = 20_000
ROWS_PER_TASK = 4_000_000
#: Parts that a language's phrases are ranked in before all of them are.
PARTS = 64
#: Languages whose totals are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 10_000


def word_line(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """All words of the texts in a row, as ranks from 1 in byte order of the word and a blank, 0 between pieces; and the words by rank."""
    line = b".".join([b"", *(t.encode() for t in texts), b""]).translate(FOLD).replace(b".", b" . ").decode()
    flat = pc.ascii_split_whitespace(pa.array([line])).flatten()
    flat = flat.filter(pc.greater(pc.binary_length(flat), 0)).dictionary_encode()
    ended = pc.binary_join_element_wise(flat.dictionary, "", " ")
    order = pc.sort_indices(ended).to_numpy()
    words = flat.dictionary.take(pa.array(order))
    is_break = pc.equal(words, ".").to_numpy(zero_copy_only=False)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(~is_break)
    rank[order[is_break]] = 0
    return rank[flat.indices.to_numpy()], pc.filter(words, pa.array(~is_break))


def pair_slots(line: np.ndarray, words: pa.Array, lang: str, slots: int) -> np.ndarray:
    """The counter of each word and the word after it."""
    seed = xxhash.xxh64_intdigest(lang)
    own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))
    own = np.concatenate((np.zeros(1, np.uint64), own))[line]
    return (mixed(own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]) % np.uint64(slots)).astype(np.int64)


def windows(line: np.ndarray, longest: int, often: np.ndarray | None = None) -> np.ndarray:
    """Of each word the ranks of up to ``longest`` words from it on, to the end of its piece (or the first rare pair)."""
    n = len(line)
    stop = line == 0
    if often is not None:
        stop = stop | np.concatenate(([True], ~often))  # place k: the pair (k - 1, k) is rare
    out = np.zeros((n, longest), np.int64)
    out[:, 0] = line
    goes_on = np.ones(n, bool)
    for k in range(1, longest):
        goes_on[: n - k] &= ~stop[k:]
        goes_on[n - k :] = False
        out[: n - k, k] = np.where(goes_on[: n - k], line[k:], 0)
    return out[line > 0]


def counted(rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and how often each comes."""
    bits = max(words.bit_length(), 1)
    fit = 63 // bits
    keys = []
    for first in range(0, rows.shape[1], fit):
        key = np.zeros(len(rows), np.int64)
        for column in rows[:, first : first + fit].T:
            key = key << bits | column
        keys.append(key)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(new)
    return rows[order[first]], np.diff(np.append(first, len(rows)))


def window_text(rows: np.ndarray, words: pa.Array) -> pa.Array:
    """The words of each row, each with a blank after it."""
    ended = pa.concat_arrays([pa.array([""]), pc.binary_join_element_wise(words, "", " ")])
    columns = [ended.take(pa.array(c)) for c in rows.T]
    return pc.binary_join_element_wise(*columns, "")


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, batch.column("text").take(pa.array(np.flatnonzero(codes == k))).to_pylist()


def _survey(rows: DataFrame, longest: int, slots: int) -> DataFrame:
    """Per task blocks of pair counters (``block`` >= 0), words by language (-1) and sampled windows (-2)."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, totals = np.zeros(slots, np.int64), {}
        rng = np.random.default_rng(TaskContext.get().partitionId())
        names = ["block", "lang", "n", "body"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.binary()]

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(kinds)], names)

        for batch in chunks(batches, size=CHUNK):
            for lang, texts in by_language(batch):
                line, words = word_line(texts)
                totals[lang] = totals.get(lang, 0) + int((line > 0).sum())
                both = (line[:-1] > 0) & (line[1:] > 0)
                counters += np.bincount(pair_slots(line, words, lang, slots)[both], minlength=slots)
                some = windows(line, longest)
                if len(some):
                    some = some[rng.integers(0, len(some), min(SAMPLED, len(some)))]
                    keys = rng.integers(0, 1 << 62, len(some)).tolist()
                    yield out([(-2, lang, key, w.encode()) for key, w in zip(keys, window_text(some, words).to_pylist())])
        yield out([(-1, lang, n, None) for lang, n in totals.items()])
        for block in range(slots // BLOCK if totals else 0):
            part = np.minimum(counters[block * BLOCK : (block + 1) * BLOCK], np.iinfo(np.uint16).max)
            yield out([(block, None, None, part.astype("<u2").tobytes())])

    return staged(rows.mapInArrow(survey, "block int, lang string, n bigint, body binary"), "phrase-survey")


def _frequent_slots(survey: DataFrame, slots: int, least: int) -> np.ndarray:
    """For each counter whether it reached ``least`` over all tasks (capped sums lie above it as well)."""
    least = min(least, np.iinfo(np.uint16).max)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist()):
                counts = np.frombuffer(body, "<u2").astype(np.int64)
                sums[block] = sums[block] + counts if block in sums else counts
        bits = [np.packbits(s >= least).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], ["block", "bits"])

    found = survey.where("block >= 0").select("block", "body").repartition(min(16, slots // BLOCK), "block")
    often = np.zeros(slots // 8, np.uint8)
    for row in found.mapInArrow(add, "block int, bits binary").collect():  # a bit for each counter
        often[row.block * (BLOCK // 8) : (row.block + 1) * (BLOCK // 8)] = np.frombuffer(row.bits, np.uint8)
    return np.unpackbits(often).astype(bool)


def _ranges(survey: DataFrame, ranges: int) -> list[tuple[str, bytes]]:
    """Windows that cut the order of (language, window) into ``ranges`` of about the same size."""
    drawn = survey.where("block = -2")  # with random numbers below 2**62
    share = int((1 << 62) * min(1.0, SAMPLE / max(drawn.count(), 1)))
    sample = drawn.where(F.col("n") < share).select("lang", "body").collect()
    ordered = sorted({(r.lang, bytes(r.body)) for r in sample})
    return sorted({ordered[k * len(ordered) // ranges] for k in range(1, ranges)}) if ordered else []


def range_starts(rows: np.ndarray, words: pa.Array, lang: str, cuts: list[tuple[str, bytes]]) -> list[int]:
    """The first of the ordered ``rows`` that is not below each cut."""
    ended = [w.encode() + b" " for w in words.to_pylist()]
    starts = []
    for cut_lang, cut in cuts:
        if cut_lang != lang:
            starts.append(0 if cut_lang < lang else len(rows))
            continue
        # ranks of the cut's words, a half for a word between two; no window has a word after a half
        ranks: list[float] = []
        for token in cut.split(b" ")[:-1]:
            at = bisect_left(ended, token + b" ")
            known = at < len(ended) and ended[at] == token + b" "
            ranks.append(at + 1 if known else at + 0.5)
        starts.append(bisect_left(rows, tuple(ranks), key=tuple))
    return starts


def _window_counts(rows: DataFrame, longest: int, slots: int, often: np.ndarray, cuts: list[tuple[str, bytes]]) -> DataFrame:
    """``part``, ``lang``, ``window``, ``n``: each task's windows with their number, in the range they belong to."""
    frequent = rows.sparkSession.sparkContext.broadcast(often)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=CHUNK):
            for lang, texts in by_language(batch):
                line, words = word_line(texts)
                if not len(words):
                    continue
                found, n = counted(windows(line, longest, frequent.value[pair_slots(line, words, lang, slots)]), len(words))
                starts = range_starts(found, words, lang, cuts)
                part = np.searchsorted(np.array(starts, np.int64), np.arange(len(found)), side="right").astype(np.int32)
                for k in range(0, len(found), 100_000):
                    some = slice(k, k + 100_000)
                    text = window_text(found[some], words)
                    arrays = [pa.array(part[some]), pa.array([lang] * len(text), pa.string()), text, pa.array(n[some])]
                    yield pa.RecordBatch.from_arrays(arrays, ["part", "lang", "window", "n"])

    return rows.mapInArrow(count, "part int, lang string, window string, n bigint")


def prefix_counts(batches: Iterator[pa.RecordBatch], longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of all beginnings of the ordered windows: ``lang``, ``phrase``, ``words``, ``f``.

    Beginnings with fewer than ``least`` are left out, except the first and last ones of the stream, which may
    go on in another.
    """
    names, kinds = ["lang", "phrase", "words", "f"], [pa.string(), pa.string(), pa.int32(), pa.int64()]
    open_: list[tuple[str, str, int, bool] | None] = [None] * longest  # language, phrase, count, whether at the edge
    before: tuple[str, list[str]] | None = None
    found: list[tuple[str, str, int, int]] = []

    def close(k: int) -> None:
        if open_[k] is not None and (open_[k][3] or open_[k][2] >= least):
            found.append((open_[k][0], open_[k][1], k + 1, open_[k][2]))
        open_[k] = None

    def flush() -> pa.RecordBatch:
        out = [pa.array([r[k] for r in found], t) for k, t in enumerate(kinds)]
        found.clear()
        return pa.RecordBatch.from_arrays(out, names)

    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        lists = pc.split_pattern(batch.column("window"), " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        tokens = lists.values.dictionary_encode().indices.to_numpy()
        sizes = np.diff(ends) - 1
        langs = batch.column("lang").dictionary_encode().indices.to_numpy()
        n = batch.column("n").to_numpy()

        def at(row: int) -> tuple[str, list[str]]:
            return batch.column("lang")[row].as_py(), batch.column("window")[row].as_py().split(" ")[:-1]  # noqa: B023

        lang, first = at(0)
        new = np.ones(rows, bool)
        new[1:] = langs[1:] != langs[:-1]
        for k in range(longest):
            token = np.full(rows, -1, np.int64)
            filled = np.flatnonzero(sizes > k)
            token[filled] = tokens[ends[filled] + k]
            new[1:] |= token[1:] != token[:-1]
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(n, starts)
            keep = token[starts] >= 0
            goes_on = before is not None and before[0] == lang and len(first) > k and before[1][: k + 1] == first[: k + 1]
            if goes_on and open_[k] is not None:
                sums[0] += open_[k][2]
                edge = open_[k][3]
                open_[k] = None
            else:
                edge = before is None
                close(k)
            wanted = np.flatnonzero(keep & (sums >= least)).tolist()
            if edge and keep[0] and 0 not in wanted:
                wanted.insert(0, 0)
            last = len(starts) - 1
            for g in wanted:
                if g != last:
                    own, words = at(int(starts[g]))
                    found.append((own, " ".join(words[: k + 1]), k + 1, int(sums[g])))
            if keep[last]:
                own, words = at(int(starts[last]))
                open_[k] = (own, " ".join(words[: k + 1]), int(sums[last]), edge and last == 0)
        before = at(rows - 1)
        yield flush()
    for k in range(longest):
        if open_[k] is not None:
            open_[k] = (*open_[k][:3], True)
            close(k)
    yield flush()


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang_column: str = "lang", text_column: str = "text", slots: int = SLOTS
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``words``, ``f`` of all phrases of up to ``longest`` words that come ``least`` times; ``lang``, ``n``.

    A first reading counts pairs of words in ``slots`` counters, which never count too little. The second
    sends one window for each word: the words from it on, up to a pair that is rare for sure. Windows go
    to ranges of their order, are sorted, and each range counts the beginnings of its windows in one go;
    what a range's edges cut in two is added up.
    """
    with_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(quoted(lang_column)).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_column).alias("text"))
    survey = _survey(rows, longest, slots)
    totals = staged(survey.where("block = -1").groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-all_words // ROWS_PER_TASK))
    cuts = _ranges(survey, ranges)
    found = _window_counts(rows, longest, slots, _frequent_slots(survey, slots, least), cuts)
    ordered = found.repartitionById(len(cuts) + 1, F.col("part")).select("lang", "window", "n").sortWithinPartitions("lang", "window")
    parts = ordered.mapInArrow(lambda b: prefix_counts(b, longest, least), "lang string, phrase string, words int, f bigint")
    whole = parts.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return staged(whole, "phrase-counts"), totals


def find_phrases(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    contained: int = 100,
    lang_column: str = "lang",
    text_column: str = "text",
    slots: int = SLOTS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut at marks and line ends into pieces, pieces at blanks and tabs into
    words. A candidate has 2 to ``longest`` words and comes ``least`` times or more (``a``). Cut after k of its words,
    its parts come ``l`` and ``r`` times, all words of the language ``n`` times; the score is the smallest
    floor(1000 * a * n / (l * r)), of the first such cut. A candidate inside a longer one that comes at least
    ``contained`` hundredths as often is dropped: then one with a word more at its left or right end does.

    Counts lie in the order of phrases. Each cut's first part is looked up by a merge join in that order, its rest
    by one in the order of rests, and the counts of extensions go back the same way.

    Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows count each time;
    an empty table gives an empty one; phrases are ranked by score, then ``a``, then byte order, so that
    there are no ties; other columns do not matter.
    """
    counts, totals = phrase_counts(docs, longest, least, lang_column, text_column, slots)
    totals = F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals
    words = F.split("phrase", " ")

    def part(first: Column, size: Column) -> Column:
        return F.array_join(F.slice(words, first, size), " ")

    cut = counts.where("words > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("lang", "phrase", "words", F.col("f").alias("a"), "cut", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    cut = staged(cut, "phrase-cuts")
    prefix_order = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    suffix_order = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parted = cut.join(prefix_order.hint("merge"), ["lang", "first"]).join(suffix_order.hint("merge"), ["lang", "rest"])
    exact = "(1000 * cast(a AS decimal(38, 0)) * n) div (cast(l AS decimal(38, 0)) * r)"
    scored = parted.join(totals, "lang").select("lang", "phrase", "a", "n", F.struct(F.expr(exact).alias("score"), "cut", "l", "r").alias("s"))
    scored = scored.groupBy("lang", "phrase", "a", "n").agg(F.min("s").alias("s"))
    right = cut.where("cut = words - 1").select("lang", F.col("first").alias("phrase"), F.col("a").alias("longer"))
    left = cut.where("cut = 1").select("lang", F.col("rest").alias("phrase"), F.col("a").alias("longer"))
    longer = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer.hint("merge"), ["lang", "phrase"], "left").where(F.expr(f"coalesce(100 * longer < {int(contained)} * a, true)"))
    best = [F.desc("s.score"), F.desc("a"), F.col("phrase")]
    # a language's phrases are ranked in parts first, so that one task gets few of them
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    first = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "s.l", "s.r", "n", "s.score")
