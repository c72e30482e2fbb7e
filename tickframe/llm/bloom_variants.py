"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary's words go into blocked Bloom filters, one shard for each word
length, which are broadcast.  Every word generates its edits (each letter left
out; each letter replaced by a larger one of the vocabulary's alphabet), so
that each unordered pair of words one edit apart is generated once, from the
longer word or from that with the smaller letter.  Edits are numbers, not
strings: a polynomial of the letters, from which an edit takes one term away.
Only an edit that its shard's filter holds becomes a string and is shuffled to
an exact join with the vocabulary, which removes the false positives.

The filters take 16 bits a word, in blocks of 512 bits.  What is broadcast at
once is bounded by FILTER_BYTES: a larger vocabulary is probed in several
passes, each with the next part of the blocks, and loses nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm._common import written

FEWEST_LETTERS = 5
FEWEST_OCCURRENCES = 3
#: A run whose checksum this divides loses a letter.
THINNED = 97
#: A form occurs so many times as often as the word, or more.
RATIO = 2

#: Lengths up to this have a shard each; longer ones share a shard by the logarithm of their length.
OWN_SHARDS = 64
BLOCK_BITS = 512
BITS_A_WORD = 16
FILTER_BYTES = 32 << 20
CHUNK_BLOCKS = 4096
PROBES_AT_ONCE = 1 << 20
KEPT_WORDS = 200_000
KEPT_LETTERS = 16 << 20
WORDS_A_TASK = 20_000

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SALTS = np.array([2 * pow(7, 21 + i, 1 << 62) + 1 for i in range(8)], dtype=np.uint64)  # one bit of each of the block's eight words


def counted_words(docs: DataFrame, fewest_letters: int = FEWEST_LETTERS, thinned: int = THINNED) -> DataFrame:
    """Words of all texts and how often they occur: (word, n).

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased.  Where ``thinned``
    divides the crc32 of ``<doc_id>:<word>`` the word loses its letter number crc32 modulo length.  Words of fewer than
    ``fewest_letters`` letters (then) don't count.  A null text has no words; a null doc_id is written as nothing.
    Each task adds up what it reads, in a table of bounded size, before the shuffle.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % fewest_letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        letters = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                for word, n in Counter(runs.findall(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % thinned == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < fewest_letters:
                            continue
                    known = found.get(word)
                    if known is None:
                        letters += len(word)
                    found[word] = n + (known or 0)
                if len(found) >= KEPT_WORDS or letters >= KEPT_LETTERS:
                    yield rows(found)
                    found, letters = {}, 0
        yield rows(found)

    def rows(found: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def shard_of(length: int) -> int:
    if length <= OWN_SHARDS:
        return length
    return OWN_SHARDS + int(16 * np.log2(length / OWN_SHARDS))


def letters_of(words: Sequence[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1).astype(np.uint64)


def powers(length: int) -> np.ndarray:
    out = np.full(length, BASE, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bits_of(x: np.ndarray, lane: int) -> np.ndarray:
    return (x * SALTS[lane]) >> np.uint64(58)


@dataclass
class Filters:
    """Blocks ``begin`` to ``begin + len(lanes)`` of the filters; ``shards`` has each shard's first block, blocks and words."""

    shards: dict[int, tuple[int, int, int]]
    begin: int
    lanes: np.ndarray

    @staticmethod
    def places(shards: dict[int, tuple[int, int, int]], shard: int, x: np.ndarray) -> np.ndarray:
        first, blocks, _ = shards[shard]
        return first + (((x >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)

    def held(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of those that the filter may hold."""
        x = mixed(hashes)
        at = self.places(self.shards, shard, x) - self.begin
        kept = np.flatnonzero((at >= 0) & (at < len(self.lanes)))
        for lane in range(8):
            set_there = (self.lanes[at[kept], lane] >> bits_of(x[kept], lane)) & np.uint64(1)
            kept = kept[set_there.astype(bool)]
        return kept

    def words_in(self, length: int) -> int:
        return self.shards.get(shard_of(length), (0, 0, 0))[2]

    def edits(self, words: Sequence[str], alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
        """(place of the word, edit) of all edits of words of one length that the filters may hold."""
        length = len(words[0])
        codes, scale = letters_of(words), powers(length)
        terms = codes * scale
        whole = terms.sum(axis=1, dtype=np.uint64)
        if self.words_in(length - 1):
            before = np.cumsum(terms, axis=1, dtype=np.uint64)
            shorter = (before - terms) + (whole[:, None] - before) * INVERSE
            first = np.ones(codes.shape, dtype=bool)  # of equal letters in a row only the first is left out
            first[:, 1:] = codes[:, 1:] != codes[:, :-1]
            word, place = np.nonzero(first)
            for hit in self.held(shard_of(length - 1), shorter[word, place]):
                w, p = words[word[hit]], place[hit]
                yield int(word[hit]), w[:p] + w[p + 1:]
        if self.words_in(length) < 2:
            return
        step = max(1, PROBES_AT_ONCE // max(1, len(words) * len(alphabet)))
        for begin in range(0, length, step):
            part = slice(begin, begin + step)
            word, place, letter = np.nonzero(alphabet[None, None, :] > codes[:, part, None])
            place += begin
            hashes = whole[word] + (alphabet[letter] - codes[word, place]) * scale[place]
            for hit in self.held(shard_of(length), hashes):
                w, p = words[word[hit]], place[hit]
                yield int(word[hit]), w[:p] + chr(int(alphabet[letter[hit]])) + w[p + 1:]


def _hashed_by_length(words: list[str]) -> Iterator[tuple[int, list[int], list[str]]]:
    """Places and words by length."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, at in groups.items():
        step = max(1, (1 << 18) // max(length, 1))
        for i in range(0, len(at), step):
            yield length, at[i:i + step], [words[j] for j in at[i:i + step]]


def _sized(vocabulary: DataFrame) -> tuple[dict[int, tuple[int, int, int]], int]:
    """First block, blocks and words of each shard, and the sum of the blocks."""
    sizes: Counter = Counter()
    for row in vocabulary.groupBy(F.least(F.length("word"), F.lit(1 << 24)).alias("length")).count().collect():  # a row per length
        sizes[shard_of(row["length"])] += row["count"]
    shards, total = {}, 0
    for shard, n in sorted(sizes.items()):
        blocks = -(-n * BITS_A_WORD // BLOCK_BITS)
        shards[shard] = (total, blocks, n)
        total += blocks
    return shards, total


def _filters(spread: DataFrame, shards: dict[int, tuple[int, int, int]], begin: int, blocks: int) -> Filters:
    """The filter blocks from ``begin``: hashes are shuffled by chunk of blocks, and each chunk is filled by one task."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, words in _hashed_by_length(batch.column(0).to_pylist()):
                x = mixed((letters_of(words) * powers(length)).sum(axis=1, dtype=np.uint64))
                at = Filters.places(shards, shard_of(length), x) - begin
                mine = (at >= 0) & (at < blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[mine] // CHUNK_BLOCKS), pa.array(at[mine] % CHUNK_BLOCKS), pa.array(x[mine].view(np.int64))],
                    ["chunk", "block", "x"])

    def filled(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lanes = np.zeros((CHUNK_BLOCKS, 8), dtype=np.uint64)
        x = rows.column("x").to_numpy().view(np.uint64)
        for lane in range(8):
            np.bitwise_or.at(lanes, (rows.column("block").to_numpy(), lane), np.uint64(1) << bits_of(x, lane))
        return pa.table([pa.array([key[0].as_py()]), pa.array([lanes.tobytes()], pa.binary())], ["chunk", "bits"])

    chunks = (spread.select("word").mapInArrow(hashed, "chunk bigint, block bigint, x bigint")
              .groupBy("chunk").applyInArrow(filled, "chunk bigint, bits binary").toArrow())  # FILTER_BYTES at most
    lanes = np.zeros((blocks, 8), dtype=np.uint64)
    for chunk, bits in zip(chunks.column("chunk").to_pylist(), chunks.column("bits"), strict=True):
        part = lanes[chunk * CHUNK_BLOCKS:(chunk + 1) * CHUNK_BLOCKS]
        part[:] = np.frombuffer(bits.as_buffer(), dtype=np.uint64).reshape(-1, 8)[:len(part)]
    return Filters(shards, begin, lanes)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """Each unordered pair of words one edit apart once: (word, n, near, near_n); ``vocabulary`` is (word, n), words distinct."""
    spark = vocabulary.sparkSession
    shards, total = _sized(vocabulary)
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(n for _, _, n in shards.values()) // WORDS_A_TASK))
    spread = vocabulary.select("word", "n").repartition(tasks, "word")
    alphabet = np.array(sorted(ord(r[0]) for r in spread.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"))
                               .where("c != ''").distinct().collect()), dtype=np.uint64)  # the letters of the alphabet, 90 at most
    found = []
    for begin in range(0, total, FILTER_BYTES * 8 // BLOCK_BITS):
        filters = _filters(spread, shards, begin, min(FILTER_BYTES * 8 // BLOCK_BITS, total - begin))
        found.append(_probed(spark, spread, filters, alphabet))
    if not found:
        return spark.createDataFrame([], "word string, n bigint, near string, near_n bigint")
    positives = found[0]
    for more in found[1:]:
        positives = positives.unionByName(more)
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return positives.join(exact, "near").select("word", "n", "near", "near_n")


def _probed(spark: SparkSession, spread: DataFrame, filters: Filters, alphabet: np.ndarray) -> DataFrame:
    shared = spark.sparkContext.broadcast((filters, alphabet))  # bounded by FILTER_BYTES

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = shared.value
        for batch in batches:
            counts = batch.column(1)
            for _, at, words in _hashed_by_length(batch.column(0).to_pylist()):
                step = max(1, PROBES_AT_ONCE // (len(words[0]) * max(1, len(letters))))
                for i in range(0, len(words), step):
                    hits = list(held.edits(words[i:i + step], letters))
                    rows = pa.array([at[i + w] for w, _ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i + w] for w, _ in hits], pa.string()), counts.take(rows),
                         pa.array([e for _, e in hits], pa.string())], ["word", "n", "near"])

    positives = written(spread.mapInArrow(probe, "word string, n bigint, near string"), "variants-positives")
    shared.unpersist()
    return positives


def variants(vocabulary: DataFrame) -> DataFrame:
    """Form and root of each word of ``vocabulary`` (word, n; words distinct): (word, form, root, n, n_near, form_n).

    Two words are near if they differ by one inserted, deleted or replaced letter.  A word's form is the near word that
    occurs most often (ties: the smallest in code-point order), if it occurs at least twice as often as the word; else it is
    null, and so is form_n.  The root follows the forms to the last, the word itself where it has none.  Each step doubles
    what a chain of forms has covered, and a chain has no more links than the largest count has bits.
    """
    vocabulary = written(vocabulary.select("word", "n"), "variants-words")
    pairs = near_pairs(vocabulary)
    both = pairs.select(F.explode(F.array(F.struct("word", "near", F.col("near_n").alias("m")),
                                          F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")))).alias("p"))
    best = both.select("p.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near"))).alias("best"))
    often = -F.col("best.m") >= RATIO * F.col("n")
    formed = written(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(often, F.col("best.near")).alias("form"),
        F.when(often, -F.col("best.m")).alias("form_n")), "variants-forms")
    links = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return formed.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
