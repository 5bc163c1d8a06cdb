"""Periodic runs of words, found in tiles scaled to the period and stitched together by document and period."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import quoted, staged, text_or_empty, with_package
from segloom.llm.words import chunks, joined, mixed, rolling, split_words, word_codes

#: Words of a run at least, and at least twice its period.
LEAST = 12
#: Words of a tile for all short periods. Neighbouring tiles share a quarter of it.
TILE = 1 << 16
#: Moduli and bases of the two hashes that compare stretches; reported runs are compared word by word.
FIELDS = ((2**31 - 1, 1_103_515_245), (2_147_483_629, 1_664_525_877))
#: Words that the first comparison looks at, at most.
GRAM = 8

FRAGMENT = "struct<period: bigint, start: bigint, end: bigint>"


def octave(period: int) -> int:
    return period.bit_length() - 1


def tiles(n: int, least: int = LEAST, size: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, one after the last, first word, one after the last word) of the tiles of ``n`` words.

    An octave k holds the periods from 2**k to 2**(k+1) - 1. Tiles of an octave share so many words
    that each stretch of two periods (and of ``least`` words) lies in one of them.
    """
    top = octave(max(n // 2, 1)) + 1
    if n <= size:
        if n >= least:
            yield 0, top, 0, n
        return
    base = octave(size // 4) - 2  # 2 * 2**(base + 1) <= size / 4
    for low, high, length, shared in [
        (0, base + 1, size, size // 4),
        *[(k, k + 1, 8 << k, 4 << k) for k in range(base + 1, top)],
    ]:
        start = 0
        while True:
            yield low, high, start, min(start + length, n)
            if start + length >= n:
                break
            start += length - shared


@lru_cache(maxsize=4)
def smallest_factors(size: int) -> np.ndarray:
    """The smallest prime factor of each number below ``size``, a power of two."""
    factors = np.arange(size, dtype=np.int64)
    for p in range(2, int(size**0.5) + 1):
        if factors[p] == p:
            multiples = factors[p * p :: p]
            multiples[multiples == np.arange(p * p, size, p)] = p
    return factors


class Stretches:
    """Compares stretches of codes by two hashes, without reading them."""

    def __init__(self, codes: np.ndarray):
        self.hashes = []
        for modulus, base in FIELDS:
            powers = np.ones(len(codes) + 1, np.uint64)
            filled, step = 1, np.uint64(base)
            while filled < len(powers):
                more = min(filled, len(powers) - filled)
                powers[filled : filled + more] = powers[:more] * step % np.uint64(modulus)
                step = step * step % np.uint64(modulus)
                filled += more
            terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[:-1] % np.uint64(modulus)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(modulus)))
            self.hashes.append((np.uint64(modulus), powers, sums))

    def same(self, at: np.ndarray, apart: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``at`` and ``apart`` words behind it agree for ``length`` words."""
        agree = np.ones(len(at), bool)
        for modulus, powers, sums in self.hashes:
            here = (sums[at + length] + modulus - sums[at]) % modulus
            there = (sums[at + apart + length] + modulus - sums[at + apart]) % modulus
            agree &= here * powers[apart] % modulus == there
        return agree

    def reach(self, at: np.ndarray, apart: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) agree with those ``apart`` behind them, at most ``most``."""
        found = np.zeros(len(at), np.int64)
        step = 1 << octave(int(most.max(initial=1)) or 1)
        while step:
            open_ = np.flatnonzero(found + step <= most)
            first = at[open_] + found[open_] if ahead else at[open_] - found[open_] - step
            good = open_[self.same(first, apart[open_], np.full(len(open_), step))]
            found[good] += step
            step >>= 1
        return found


def find_runs(
    codes: np.ndarray, ends: np.ndarray, low: int = 0, high: int = 64, least: int = LEAST
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tile, first word, one after the last word, and smallest period of every run within each tile.

    Tile k has the codes from ``ends[k]`` to ``ends[k + 1]``; a run has at least ``least`` words and two periods,
    and a period of the octaves from ``low`` to ``high`` - 1. Each octave puts a boundary every 2**k words. The
    words that repeat at a distance p form a stretch of at least p words, which holds a boundary; from there the
    agreement with the words p further on is followed forward and backward (the values of the Z-function at the
    boundary). Only boundaries with a few agreeing words on the longer side are followed.
    """
    lengths = np.diff(ends)
    # longest first, so that an octave's tiles are a beginning; one code of its own after each tile and around all
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = GRAM + np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    total = int(sizes.sum()) + len(sizes)
    own = (int(codes.max(initial=-1)) + 1) + np.arange(total + 2 * GRAM, dtype=np.int64)
    line = own.copy()
    tile = np.repeat(np.arange(len(sizes)), sizes + 1)
    within = np.arange(total) - np.repeat(starts - GRAM, sizes + 1)
    inside = np.flatnonzero(within < np.repeat(sizes, sizes + 1))
    line[GRAM + inside] = codes[np.repeat(ends[:-1][order], sizes) + within[inside]]
    spread = mixed(line)
    grams = {1: spread}
    stretches = None
    parts = []
    for k in range(low, min(high, octave(max(int(sizes.max(initial=0)) // 2, 1)) + 1)):
        unit = 1 << k
        fit = int(np.searchsorted(-sizes, -max(least, 2 * unit), side="right"))
        if not fit:
            break
        shortest = min(max(least - p, p) for p in range(unit, min(2 * unit, max(unit + 1, least))))
        width = min(GRAM, max(1, -(-shortest // 2)))
        if width not in grams:
            grams[width] = rolling(spread, width, np.uint64(0x9E3779B97F4A7C15))
        gram = grams[width]
        # each place belongs to one boundary: the one whose periods of this octave reach it
        stop = int(starts[fit - 1] + sizes[fit - 1] + 1) - GRAM
        rel = within[:stop]
        place = np.flatnonzero(rel >= unit)
        rel = rel[place]
        place = place + GRAM
        border = place - rel + (((rel >> k) - 1) << k)
        hit = np.flatnonzero((gram[place] == gram[border]) | (gram[place - width] == gram[border - width]))
        if not len(hit):
            continue
        stretches = stretches or Stretches(line)
        place, border = place[hit], border[hit]
        period = place - border
        of = tile[place - GRAM]
        ahead = stretches.reach(border, period, starts[of] + sizes[of] - place, True)
        back = stretches.reach(border, period, border - starts[of], False)
        long = np.flatnonzero(ahead + back >= np.maximum(least - period, period))
        first, last, period = (border - back)[long], (place + ahead)[long], period[long]
        _, once = np.unique(first << 32 | period, return_index=True)
        first, last, period = first[once], last[once], period[once]
        prime = _primitive(stretches, first, last, period)
        parts.append((first[prime], last[prime], period[prime]))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    first, last, period = (np.concatenate(p) for p in zip(*parts))
    for f, e, p in zip(first.tolist(), last.tolist(), period.tolist()):
        if not np.array_equal(line[f : e - p], line[f + p : e]):
            raise ArithmeticError("two different stretches have the same two hashes; change FIELDS")
    of = tile[first - GRAM]
    return order[of], first - starts[of], last - starts[of], period


def _primitive(stretches: Stretches, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Runs without a smaller period, which would divide the period."""
    rest = period.copy()
    good = np.ones(len(period), bool)
    factors = smallest_factors(1 << int(period.max(initial=1)).bit_length())
    while (rest > 1).any():
        prime = np.where(rest > 1, factors[rest], 1)
        at = np.flatnonzero(prime > 1)
        part = period[at] // prime[at]
        good[at[stretches.same(first[at], part, last[at] - first[at] - part)]] = False
        while len(at):
            rest[at] //= prime[at]
            at = at[rest[at] % prime[at] == 0]
    return good


def _marked(docs: DataFrame, keep: list[str], text_column: str, least: int, tile: int) -> DataFrame:
    """Per document ``uid``, the kept columns, its words and the fragments of its one tile; or its tiles, one a row."""
    texts = docs.select(F.struct(*[F.col(quoted(c)) for c in keep], F.lit(0).alias("__")).alias("row"), text_or_empty(text_column).alias("text"))
    kind = texts.schema["row"].dataType
    outputs = f"uid bigint, row {kind.simpleString()}, words string, n_words bigint, whole boolean, fragments array<{FRAGMENT}>, low int, high int, start bigint, codes binary"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        names = ["uid", "row", "words", "n_words", "whole", "fragments", "low", "high", "start", "codes"]
        shape = pa.list_(pa.struct([(c, pa.int64()) for c in ("period", "start", "end")]))
        for batch in chunks(batches):
            words, ends = split_words(batch.column("text"))
            codes, _ = word_codes(words)
            sizes = np.diff(ends)
            whole = sizes <= tile
            # a longer document has no words here: its tiles follow as rows of their own
            cut = np.concatenate(([0], np.cumsum(np.where(whole, sizes, 0))))
            of, first, last, period = find_runs(codes[np.repeat(whole, sizes)], cut, least=least)
            by = np.argsort(of, kind="stable")
            fragments = pa.StructArray.from_arrays([pa.array(x[by]) for x in (period, first, last)], ["period", "start", "end"])
            many = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(sizes))))).astype(np.int32)
            rows, n = uid + np.arange(len(sizes)), len(sizes)
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary())]
            arrays = [pa.array(rows), batch.column("row"), joined(words, ends), pa.array(sizes), pa.array(whole), pa.ListArray.from_arrays(pa.array(many), fragments), *none]
            yield pa.RecordBatch.from_arrays(arrays, names)
            for k in np.flatnonzero(~whole):
                own = codes[ends[k] : ends[k + 1]]
                for low, high, start, end in tiles(len(own), least, tile):
                    values = [int(rows[k]), None, None, None, None, None, low, high, start, own[start:end].astype(np.uint32).tobytes()]
                    kinds = [pa.int64(), batch.column("row").type, pa.string(), pa.int64(), pa.bool_(), shape, pa.int32(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)
            uid += n

    return staged(texts.mapInArrow(mark, outputs), "period-tiles")


def _solve(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uid, low, high, start, codes in zip(*(batch.column(c).to_pylist() for c in ("uid", "low", "high", "start", "codes"))):
            own = np.frombuffer(codes, np.uint32).astype(np.int64)
            _, first, last, period = find_runs(own, np.array([0, len(own)]), low, high, least)
            arrays = [pa.array(np.full(len(first), uid)), pa.array(period), pa.array(first + start), pa.array(last + start)]
            yield pa.RecordBatch.from_arrays(arrays, ["uid", "period", "start", "end"])


def _stitched(fragments: DataFrame) -> DataFrame:
    """Runs of each document from ``uid``, ``period``, ``start``, ``end`` of its fragments.

    Two runs of one period share fewer words than it has; fragments that share more are of one run.
    """
    line = Window.partitionBy("uid", "period").orderBy("start", "end")
    before = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((before - F.col("start") < F.col("period")).cast("int"), F.lit(1))
    pieces = fragments.withColumn("opens", opens).withColumn("run", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    runs = pieces.groupBy("uid", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    run = F.struct("start", (F.col("end") - F.col("start")).alias("length"), "period")
    return runs.groupBy("uid").agg(F.sort_array(F.collect_list(run)).alias("runs"))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words without those that a run holds after its first period."""
    for batch in batches:
        texts = []
        for text, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
            words = text.split(" ") if text else []
            edges = np.zeros(len(words) + 1, np.int64)
            for run in runs:
                edges[run["start"] + run["period"]] += 1
                edges[run["start"] + run["length"]] -= 1
            gone = np.cumsum(edges)[:-1] > 0
            texts.append(" ".join([w for w, drop in zip(words, gone.tolist()) if not drop]))
        arrays = [batch.column(c) for c in ("row", "n_words", "runs")]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], ["row", "n_words", "runs", "collapsed_text"])


def periodic_runs(docs: DataFrame, text_column: str = "text", least: int = LEAST, tile: int = TILE) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_words``, ``n_runs``, ``runs`` and ``collapsed_text``.

    A run is a stretch of words with smallest period q, of at least ``least`` and 2 * q words, that no
    neighbouring word extends; ``runs`` holds (start, length, period) in words from 0, by start, then period.
    The collapsed text has the words that no run holds after its first q ones, with one blank between them.

    Tiles are scaled to the octave of the period; each is solved by itself, and fragments of a run meet by
    document and period. Documents of up to ``tile`` words are one tile, solved where it is read; those of
    longer ones are rows of their own, dealt to all tasks. Only documents with a run are moved with their text.

    Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text; repeated
    rows are treated alike, each by itself; an empty table gives an empty one; a column that is called like
    an output gives way. Runs of the same start have different periods, so that the order of runs has no ties.
    """
    with_package(docs.sparkSession)
    taken = {"n_words", "n_runs", "runs", "collapsed_text", text_column.lower()}
    keep = [c for c in docs.columns if c.lower() not in taken]
    marked = _marked(docs, keep, text_column, least, tile)
    whole = marked.where("words is not null")
    far = marked.where("codes is not null").select("uid", "low", "high", "start", "codes")
    far = far.repartition("uid", "low", "start").mapInArrow(lambda b: _solve(b, least), "uid bigint, period bigint, start bigint, end bigint")
    near = whole.where("size(fragments) > 0").select("uid", F.inline("fragments"))
    runs = _stitched(near.unionByName(far))
    some, none = F.expr("size(fragments) > 0 or not whole"), F.expr("size(fragments) = 0 and whole")
    kind = marked.schema["row"].dataType.simpleString()
    no_runs = F.expr("cast(array() as array<struct<start: bigint, length: bigint, period: bigint>>)")
    found = whole.where(some).select("uid", "row", "n_words", "words").join(runs, "uid", "left")
    found = found.select("row", "n_words", "words", F.coalesce("runs", no_runs).alias("runs"))
    found = found.mapInArrow(_collapse, f"row {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed_text string")
    rest = whole.where(none).select("row", "n_words", no_runs.alias("runs"), F.col("words").alias("collapsed_text"))
    every = found.unionByName(rest)
    columns: list[Column] = [F.col("row").getField(c).alias(c) for c in keep]
    return every.select(*columns, "n_words", F.size("runs").cast("bigint").alias("n_runs"), "runs", "collapsed_text")
