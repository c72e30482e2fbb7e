"""Removal of repeated passages, found through difference-cover anchors.

A window of ``window_words`` words is a repetition if the same words also start
earlier: in a document with a smaller id, or before it in the same document.
Every word that a repetition covers is removed; windows are judged on the input.

Only some places are hashed at first.  A difference cover modulo a period holds
residues such that any two places reach residues of the cover by one common
shift below the period.  So if two windows are equal, some anchor (a shorter run
of words that starts at a place of the cover) stands at the same offset in both:

1. hash the anchors of all documents, and find those that occur more than once;
2. extend: the windows that hold such an anchor are hashed whole (96 bits), and
   all but the first of each kind are repetitions.

In both steps a task sends one row for each hash of a batch; what a batch
already knows (an anchor or a window that repeats inside it) travels under a key
of its own.  A passage that a third of all documents share thus costs its key
one row per batch, and equal keys are read as a sorted stream, never as a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm._common import appending, byte_texts, kept_by_worker, runs_of, starts_of, written

WINDOW_WORDS = 20
BATCH_BYTES = 24_000_000
SPLIT_BYTES = 3_000_000
CACHED_WORDS = 300_000
#: Bits of an anchor's key: two that agree by chance only cost windows that are then told apart by 96 bits.
ANCHOR_BITS = 48

FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
_LAST_ID = 2**63 - 1


@lru_cache(maxsize=32)
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues, 0 among them, whose differences give every residue modulo ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("a period is at least 1")


def period_for(window_words: int) -> int:
    """Two thirds of the window at most: the anchors keep a third of its words."""
    return max(1, min(13, window_words * 2 // 3))


class _Words:
    """64-bit hashes of words, kept for a bounded number of words."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, texts: list[bytes], least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words behind each other, and each text's number of words (0 for less than ``least``)."""
        hashes, lengths = [], []
        for part in runs_of([len(t) for t in texts], SPLIT_BYTES):  # words as objects for a part at a time
            words = [w if len(w) >= least else [] for w in (t.split() for t in texts[part])]
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            known = self.known
            for w in {w for own in words for w in own}.difference(known):
                known[w] = xxhash.xxh64_intdigest(w)
            lengths += map(len, words)
            total = sum(map(len, words))
            hashes.append(np.fromiter((h for own in words for h in map(known.__getitem__, own)), dtype=np.uint64, count=total))
        return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.array(lengths, dtype=np.int64)


def _multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def run_hashes(words: np.ndarray, begin: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of the ``length`` words from each place of ``begin``: word hashes weighted by their offset."""
    out = np.zeros(len(begin), dtype=np.uint64)
    for offset, m in enumerate(_multipliers(length, seed)):
        out += words[begin + offset] * m
    return _mixed(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _own_key(row: np.ndarray) -> np.ndarray:
    """A key of the text alone, for places known to repeat: equal values behind each other take little space."""
    return _mixed(_mixed(row.view(np.uint64)) + np.uint64(0xD6E8FEB86659FD93))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words behind each other: number of the text, place in it, and words from there to its end."""
    text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    place = np.arange(len(text), dtype=np.int32) - np.repeat(starts_of(lengths)[:-1].astype(np.int32), lengths)
    return text, place, np.repeat(lengths.astype(np.int32), lengths) - place


def _anchors(docs: DataFrame, window_words: int) -> DataFrame:
    """(key, row, place) of the anchors; ~place if the batch knows that the anchor repeats."""
    period = period_for(window_words)
    in_cover, length = np.isin(np.arange(period), difference_cover(period)), window_words - period + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept_by_worker(("cover_dedup",), _Words)
        for batch in batches:
            texts, ids = byte_texts(batch.column("text")), batch.column("row").to_numpy()
            for part in runs_of([len(t) for t in texts], BATCH_BYTES):
                hashes, lengths = cache.of(texts[part], window_words)
                text, place, left = _places(lengths)
                at = np.flatnonzero(in_cover[place % period] & (left >= length))
                key, row, place = run_hashes(hashes, at, length, 1), ids[part][text[at]], place[at]
                _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                again = count[inverse] > 1
                later = np.ones(len(key), dtype=bool)
                later[first] = False
                key = np.where(later, _own_key(row), key) >> np.uint64(64 - ANCHOR_BITS)
                yield pa.RecordBatch.from_arrays(
                    [_signed(key), pa.array(row), pa.array(np.where(again, ~place, place).astype(np.int32))], ["key", "row", "place"])

    return docs.select("row", "text").mapInArrow(run, "key bigint, row bigint, place int")


def _repeated_anchors(anchors: DataFrame) -> DataFrame:
    """(row, places): the places of each text whose anchor occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of the batch before: whether it repeats may depend on the next batch
        before = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            key, row, place = now
            equal = key[1:] == key[:-1]
            repeats = np.concatenate([[before is not None and before == key[0]], equal])
            repeats[:-1] |= equal
            repeats |= place < 0
            before = key[-2] if len(key) > 1 else before
            held = [c[-1:] for c in now]
            yield _found(row[:-1], place[:-1], repeats[:-1])
        if held is not None:
            key, row, place = held
            yield _found(row, place, np.array([before is not None and before == key[0]]) | (place < 0))

    def _found(row: np.ndarray, place: np.ndarray, repeats: np.ndarray) -> pa.RecordBatch:
        place = np.where(place < 0, ~place, place)
        return pa.RecordBatch.from_arrays([pa.array(row[repeats]), pa.array(place[repeats])], ["row", "place"])

    found = anchors.repartition("key").sortWithinPartitions("key").mapInArrow(run, "row bigint, place int")
    return found.groupBy("row").agg(F.collect_list("place").alias("places"))


def _windows(docs: DataFrame, window_words: int) -> DataFrame:
    """(key, more, row) of the windows that hold a repeated anchor.

    more: 32 further bits of the hash, then a bit that is set if the batch has the same window before, then the place.
    """
    period = period_for(window_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept_by_worker(("cover_dedup",), _Words)
        for batch in batches:
            texts, ids = byte_texts(batch.column("text")), batch.column("row").to_numpy()
            anchors = batch.column("places")
            for part in runs_of([len(t) for t in texts], BATCH_BYTES):
                hashes, lengths = cache.of(texts[part])
                text, place, left = _places(lengths)
                own = anchors.slice(part.start, part.stop - part.start)
                of = np.repeat(np.arange(len(lengths)), own.value_lengths().to_numpy())
                at = own.flatten().to_numpy().astype(np.int64)
                base = starts_of(lengths)[of]
                low, high = np.maximum(at - period + 1, 0), np.minimum(at, lengths[of] - window_words)
                edge = np.zeros(len(place) + 1, dtype=np.int32)
                np.add.at(edge, base + low, 1)
                np.add.at(edge, base + np.maximum(high + 1, low), -1)
                at = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (left >= window_words))
                key = run_hashes(hashes, at, window_words, 2)
                check = run_hashes(_mixed(hashes), at, window_words, 3) & np.uint64(0xFFFFFFFF)
                row, place = ids[part][text[at]], place[at]
                order = np.lexsort((place, row, check, key))
                same = (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])
                later = np.zeros(len(key), dtype=bool)
                later[order[1:]] = same  # rows stay in the order of the texts: their numbers then take little space
                key = np.where(later, _own_key(row), key)
                more = check << np.uint64(32) | later.astype(np.uint64) << np.uint64(31) | place.astype(np.uint64)
                yield pa.RecordBatch.from_arrays([_signed(key), _signed(more), pa.array(row)], ["key", "more", "row"])

    return docs.select("row", "text", "places").mapInArrow(run, "key bigint, more bigint, row bigint")


def _repetitions(windows: DataFrame) -> DataFrame:
    """(row, repeats): the places of each text where a window starts that has started earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            key, more, row = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            check, place = more >> 32, (more & 0x7FFFFFFF).astype(np.int32)
            again = np.zeros(len(key), dtype=bool)
            again[1:] = (key[1:] == key[:-1]) & (check[1:] == check[:-1])
            again[0] = last == (key[0], check[0])
            last = (key[-1], check[-1])
            again |= (more >> 31 & 1) == 1
            yield pa.RecordBatch.from_arrays([pa.array(row[again]), pa.array(place[again])], ["row", "place"])

    found = (windows.repartition("key").sortWithinPartitions("key", F.shiftright("more", 32), "row", "more")
             .mapInArrow(run, "row bigint, place int"))
    return found.groupBy("row").agg(F.collect_list("place").alias("repeats"))


def _cut(docs: DataFrame, window_words: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, places in zip(byte_texts(batch.column("text")), batch.column("__repeats"), strict=True):
                words = text.split()
                gone = 0
                if places.is_valid:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    at = places.values.to_numpy()
                    edge[at] += 1  # places are different
                    edge[at + window_words] -= 1
                    keep = np.cumsum(edge[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                total.append(len(words) + gone)
                removed.append(gone)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield batch, [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]

    return appending(docs, FIELDS, compute).drop("__row", "__repeats")


def remove_repetitions(docs: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with n_words, n_removed and kept_text behind its columns.

    kept_text has the words that stay, joined by one space; words are runs of other characters than ASCII white space.
    One row per input row.  A null text has no words.  Rows of equal doc_id and text are one document and get equal
    results; texts of one doc_id that differ are ordered by a hash, and a null doc_id comes after all others.  An input
    column of a new column's name is replaced; all others are kept.
    """
    ids = docs.groupBy("doc_id").count().agg(F.max("count"), F.sum(F.col("doc_id").isNull().cast("int"))).first()
    if (ids[0] or 0) > 1 or ids[1]:
        # ids that don't tell the rows apart: number the different (id, text) in their order
        order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
        hashed = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
        numbered = written(hashed.dropDuplicates(["doc_id", "text_hash"]).repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("row", F.monotonically_increasing_id()), "cover-rows")
        single, whole = numbered.select("row", "text"), docs.join(
            numbered.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("row").alias("__row")),
            F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))).drop("__id", "__hash")
    else:
        single, whole = docs.select(F.col("doc_id").alias("row"), "text"), docs.withColumn("__row", F.col("doc_id"))
    anchors = written(_repeated_anchors(_anchors(single, window_words)), "cover-anchors")
    repeats = written(_repetitions(_windows(single.join(anchors, "row"), window_words)), "cover-repeats")
    named = repeats.select(F.col("row").alias("__row"), F.col("repeats").alias("__repeats"))
    return _cut(whole.join(named, "__row", "left"), window_words)
