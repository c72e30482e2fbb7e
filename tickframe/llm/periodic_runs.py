"""Maximal periodic runs of words, by internal pattern matching.

A run is a stretch of words with smallest period q, not shorter than 12 words
and than 2q, that can't be extended.  Its first words (all but q) hold an
aligned block of m = 2^k words whose copy lies q words later.  So for each
level of dyadic blocks, each block asks for its occurrences in the windows of
starts where the copies of that level's periods can lie:

    m = 4, blocks at every 2nd word:    1 <= q < 15
    m = 8, 16, ...:                2m - 1 <= q < 4m - 1

All occurrences of a block are one interval of the suffix array.  A wavelet
matrix over the suffix array answers where in an interval the next places in
the text lie (range successor).  A window holds m starts at most, so the
occurrences in it are one arithmetic progression, known from its first two
members and their number.  Its differences to the block are candidate periods;
if the block's own periodic stretch reaches the last occurrence, all but the
first are multiples of a smaller period and are left out.  A candidate is
extended to both sides by comparing classes of equal stretches of 2^k words,
which prefix doubling yields on the way to the suffix array; of equal stretches
the smallest period stays.

Texts are taken in groups of about GROUP_WORDS words (a longer text alone), as
one sequence in which no two texts have a symbol in common: numpy works on all
of them at once.  Nothing is shuffled; a task holds some 4 bytes for each word
and level of one group.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickframe.llm._common import appending

FEWEST_WORDS = 12
GROUP_WORDS = 60_000
#: Smallest block, and how far apart such blocks begin.
BLOCK, STEP = 4, 2

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_runs", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()),
    T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.StringType()),
]


class SuffixArray:
    """Suffix array by prefix doubling, with the classes of equal stretches of 2^k words at every level k.

    A class is the place of its first suffix in the suffix array, so that its suffixes are the interval from there of
    ``sizes[k]`` places.  ``repeated[k]`` are the places of the text whose stretch occurs elsewhere too.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        slots, keys = np.arange(n), symbols[order].astype(np.int64)
        self.suffixes = order.astype(np.int64)
        self.classes: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.repeated: list[np.ndarray] = []
        ranks, reach = np.zeros(n, dtype=np.int32), 1
        members = self.suffixes
        while len(members):
            heads = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            counts = np.diff(heads, append=len(keys))
            ranks = ranks.copy()
            ranks[members] = np.repeat(slots[heads], counts)
            several = np.repeat(counts > 1, counts)
            size = np.ones(n, dtype=np.int32) if not self.sizes else self.sizes[-1].copy()
            size[members] = np.repeat(counts, counts)
            self.classes.append(ranks)
            self.sizes.append(size)
            members, slots = members[several], slots[several]
            self.repeated.append(members)
            second = np.where(members + reach < n, ranks[np.minimum(members + reach, n - 1)].astype(np.int64) + 1, 0)
            keys = ranks[members].astype(np.int64) * (n + 2) + second
            order = np.argsort(keys, kind="stable")
            members, keys = members[order], keys[order]
            self.suffixes[slots] = members
            reach *= 2

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from places ``x`` and ``y`` on (different ones) are equal."""
        x, y, out = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64)
        for k in range(len(self.classes) - 1, -1, -1):
            step = np.where(self.classes[k][x] == self.classes[k][y], 1 << k, 0)
            x, y, out = x + step, y + step, out + step
        return out

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before places ``x`` < ``y`` are equal."""
        x, y, out = x.copy(), y.copy(), np.zeros(len(x), dtype=np.int64)
        for k in range(len(self.classes) - 1, -1, -1):
            there = x >= 1 << k
            step = np.where(there & (self.classes[k][np.maximum(x - (1 << k), 0)] == self.classes[k][y - (there << k)]), 1 << k, 0)
            x, y, out = x - step, y - step, out + step
        return out


class WaveletMatrix:
    """Numbers below ``limit``, with the number of smaller ones and the r-th smallest of any interval of places."""

    def __init__(self, values: np.ndarray, limit: int):
        self.levels = []
        for bit in range(max(limit - 1, 1).bit_length() - 1, -1, -1):
            ones = ((values >> bit) & 1).astype(bool)
            packed = np.zeros(len(values) // 64 + 1, dtype=np.uint64)
            raw = np.packbits(ones, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            before = np.zeros(len(packed), dtype=np.int64)
            np.cumsum(np.bitwise_count(packed)[:-1], out=before[1:])
            self.levels.append((bit, packed, before, len(values) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(packed: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[at >> 6] + np.bitwise_count(packed[at >> 6] & mask)

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many numbers at places ``low`` to ``high`` are below ``than`` (at most the limit's next power of two)."""
        out = np.zeros(len(low), dtype=np.int64)
        all_below = than >= 1 << len(self.levels)
        whole = high - low
        for bit, packed, before, zeros in self.levels:
            one_low, one_high = self._ones(packed, before, low), self._ones(packed, before, high)
            up = ((than >> bit) & 1).astype(bool)
            out += np.where(up, (high - one_high) - (low - one_low), 0)
            low = np.where(up, zeros + one_low, low - one_low)
            high = np.where(up, zeros + one_high, high - one_high)
        return np.where(all_below, whole, out)

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of that rank (from 0) at places ``low`` to ``high``."""
        out, rank = np.zeros(len(low), dtype=np.int64), rank.copy()
        for bit, packed, before, zeros in self.levels:
            one_low, one_high = self._ones(packed, before, low), self._ones(packed, before, high)
            below = (high - one_high) - (low - one_low)
            up = rank >= below
            out += np.where(up, 1 << bit, 0)
            rank -= np.where(up, below, 0)
            low = np.where(up, zeros + one_low, low - one_low)
            high = np.where(up, zeros + one_high, high - one_high)
        return out


def _windows(size: int) -> tuple[int, list[tuple[int, int]]]:
    """How far apart blocks of that size begin, and the windows of distances that they ask about."""
    if size == BLOCK:
        return STEP, [(1, 5), (5, 9), (9, 13), (13, 15)]
    return size, [(2 * size - 1, 3 * size - 1), (3 * size - 1, 4 * size - 1)]


def runs_in(symbols: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of a sequence of whole numbers below its length + 1, by start, then period."""
    index = SuffixArray(symbols)
    lowest = BLOCK.bit_length() - 1
    none = np.zeros((0, 3), dtype=np.int64)
    if len(index.repeated) <= lowest or not len(index.repeated[lowest]):
        return none
    # only suffixes whose first BLOCK words occur elsewhere can be asked for: the matrix holds these, by their rank among them
    listed = np.sort(index.repeated[lowest])
    inside = np.zeros(len(symbols) + 1, dtype=np.int64)
    inside[listed + 1] = 1
    rank_of = np.cumsum(inside)  # listed places before each place
    kept = inside[index.suffixes + 1].astype(bool)
    slot_of = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.cumsum(kept, out=slot_of[1:])
    places = WaveletMatrix(rank_of[index.suffixes[kept]], len(listed))
    begins, periods = [], []
    for level in range(lowest, len(index.repeated)):
        size = 1 << level
        step, windows = _windows(size)
        blocks = index.repeated[level]
        blocks = blocks[blocks % step == 0].astype(np.int64)
        if not len(blocks):
            continue
        first_slot = index.classes[level][blocks].astype(np.int64)
        low, high = slot_of[first_slot], slot_of[first_slot + index.sizes[level][blocks]]
        below = [places.smaller(low, high, rank_of[np.minimum(blocks + d, len(symbols))]) for d in (windows[0][0], *(w[1] for w in windows))]
        for w in range(len(windows)):
            there = np.flatnonzero(below[w + 1] > below[w])
            b, lo, hi, before = blocks[there], low[there], high[there], below[w][there]
            number = below[w + 1][there] - before
            nearest = listed[places.ranked(lo, hi, before)]
            begins.append(b)
            periods.append(nearest - b)
            more = np.flatnonzero(number > 1)
            b, nearest, number = b[more], nearest[more], number[more]
            apart = listed[places.ranked(lo[more], hi[more], before[more] + 1)] - nearest
            last = nearest + apart * (number - 1)
            # one periodic stretch from the block to its last occurrence: the rest are multiples of a smaller period
            open_ = np.flatnonzero((number == 2) | (b + index.forward(b, b + apart) + apart < last + size))
            b, nearest, number, apart = b[open_], nearest[open_], number[open_] - 1, apart[open_]
            nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + 1
            begins.append(np.repeat(b, number))
            periods.append(np.repeat(nearest - b, number) + np.repeat(apart, number) * nth)
    if not begins:
        return none
    begin, period = np.concatenate(begins), np.concatenate(periods)
    start = begin - index.backward(begin, begin + period)
    end = begin + period + index.forward(begin, begin + period)
    long = end - start >= np.maximum(FEWEST_WORDS, 2 * period)
    found = np.unique(np.stack([start[long], end[long], period[long]], axis=1), axis=0)
    found = found[np.flatnonzero(np.any(np.diff(found[:, :2], axis=0, prepend=-1), axis=1))]  # the smallest period of each stretch
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def as_written(words: list[bytes], doc_id: int | None) -> list[bytes]:
    return words


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repeated ending where the id's crc32 is a multiple of 10; other rows and null ids stay as they are."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def _results(texts: list[list[bytes]]) -> tuple[list[pa.Array], list[bytes]]:
    """Columns of FIELDS but the last, and the collapsed texts."""
    symbols, sizes, fresh = [], [len(words) + 1 for words in texts], 0
    for words in texts:
        known: dict[bytes, int] = {}
        symbols.extend([fresh + known.setdefault(w, len(known)) for w in words])
        fresh += len(known) + 1
        symbols.append(fresh - 1)  # ends the text, and occurs nowhere else
    found = runs_in(np.array(symbols, dtype=np.int64)) if symbols else np.zeros((0, 3), dtype=np.int64)
    ends = np.cumsum(np.array(sizes, dtype=np.int64))
    text_of = np.searchsorted(ends, found[:, 0], side="right")
    offsets = np.searchsorted(text_of, np.arange(len(texts) + 1))
    start, length, period = found[:, 0] - (ends - sizes)[text_of], found[:, 1] - found[:, 0], found[:, 2]
    longest = np.zeros(len(texts), dtype=np.int64)
    by_length = np.lexsort((-period, -start, length))  # the last of a text is its longest run
    longest[text_of[by_length]] = by_length
    counts = np.diff(offsets)
    empty = counts == 0
    columns = [pa.array(counts)]
    for values in (start, length, period, 1000 * length // np.maximum(period, 1)):
        columns.append(pa.array(values[longest] if len(values) else longest, mask=empty))
    structs = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], ["start", "length", "period"])
    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs))
    dropped = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 1], -1)
    dropped = np.cumsum(dropped) > 0
    collapsed = []
    for i, words in enumerate(texts):
        if counts[i]:
            gone = dropped[ends[i] - sizes[i]:ends[i] - 1].tolist()
            words = [w for w, g in zip(words, gone, strict=True) if not g]
        collapsed.append(b" ".join(words))
    return columns, collapsed


def periodic_runs(docs: DataFrame, prepared: Callable[[list[bytes], int | None], list[bytes]] = as_written) -> DataFrame:
    """``docs`` (doc_id, text) with the runs of each text's words and what is left without their repetitions.

    Words are separated by ASCII white space; ``prepared`` may change a text's words before the search.  New columns:
    n_runs; start, length, period and exponent_milli (1000 * length / period, whole) of the longest run (ties: the smallest
    start, then period), null where there is none; runs (all of them, by start, then period); collapsed: the words that no
    run holds behind its first period, joined by one space.  A null or empty text has no words, no runs and an empty
    collapsed text.  Rows are judged one by one, so repeated ids don't matter.  An input column of a new column's name is
    replaced, all others are kept.
    """
    names = [f.name.lower() for f in docs.schema.fields if f.name.lower() not in {g.name for g in FIELDS}]
    docs_at, text_at = (docs.columns.index(next(c for c in docs.columns if c.lower() == n)) for n in ("doc_id", "text"))
    assert {"doc_id", "text"} <= set(names)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            begin, held, group = 0, 0, []
            for row in range(batch.num_rows):
                text = batch.column(text_at)[row].as_py()
                words = prepared(text.encode().split() if text else [], batch.column(docs_at)[row].as_py())
                if group and held + len(words) > GROUP_WORDS:
                    yield done(batch, begin, group)
                    begin, held, group = row, 0, []
                group.append(words)
                held += len(words) + 1
            if group:
                yield done(batch, begin, group)

    def done(batch: pa.RecordBatch, begin: int, group: list[list[bytes]]) -> tuple[pa.RecordBatch, list[pa.Array]]:
        columns, collapsed = _results(group)
        return batch.slice(begin, len(group)), [*columns, pa.array([c.decode() for c in collapsed], pa.string())]

    return appending(docs, FIELDS, compute)
