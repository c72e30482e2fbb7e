"""SimHash near-duplicates by pivot distance tables.

A fingerprint has one bit per hash bit: 1 if that bit is set in over half of
the hashes of the text's shingles.  Fingerprints link if at most
``max_distance`` bits differ; a class is a connected component of links.

A pivot table holds the Hamming distances of each fingerprint to many reference
fingerprints.  Two fingerprints that differ in d bits differ by at most d in
each coordinate, so a pair is discarded by its largest coordinate difference
without comparing the fingerprints:

1. *Block references* are zero outside one block of bits and form a resolving
   set inside it: with the zero fingerprint's distance taken away, their
   coordinates are decided by the block and tell all its values apart.  Four
   differing bits leave some ``kept`` of ``blocks`` blocks untouched, and on the
   references of these the coordinate difference must be 0.  So the coordinates
   are a join key, and Spark's shuffle discards all pairs that differ in them.
2. *Spread references* lie all over the space; a pair that shares a key is
   discarded if some coordinate differs by more than ``max_distance``.
3. Survivors are verified by their differing bits.

The number of blocks follows the number of fingerprints, so that chance pairs
stay few per fingerprint; it does not change the result.  Equal fingerprints
are one node.  A key shared by many fingerprints is split into blocks of rows
that are compared pairwise; inside a block only the links of a spanning forest
leave, so a group of near copies costs no output in the square of its size.
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

from tickframe.llm._common import appending, byte_texts, kept_by_worker, written
from tickframe.llm.components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
SPREAD_REFERENCES = 32
#: (blocks, blocks that must agree) by growing selectivity; for a distance of 4 each leaves ``kept`` blocks untouched.
EXTRA_BLOCKS = (2, 3, 4)
CHANCE_PAIRS = 16
BLOCK_ROWS = 1024

FIELDS = [T.StructField("fp", T.LongType())]


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = xxhash.xxh64_digest(line, SEED)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        begins = [0, *ends[:-shingle_words].tolist()]
        stops = (ends[shingle_words - 1:] - 1).tolist()
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[i:j], SEED) for i, j in zip(begins, stops, strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    on = bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)
    return int(np.packbits(on).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint fp (bigint) behind its columns; a null text has that of the empty text, 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        kept_by_worker(("simhash_pivots",))
        for batch in batches:
            known: dict[bytes, int] = {}  # copies often follow each other
            found = []
            for t in byte_texts(batch.column(text)):
                if t not in known:
                    if len(known) > 256:
                        known.clear()
                    known[t] = fingerprint(t, shingle_words)
                found.append(known[t])
            yield batch, [pa.array(found, pa.int64())]

    return appending(docs, FIELDS, compute)


@lru_cache(maxsize=32)
def resolving_set(width: int) -> tuple[int, ...]:
    """Patterns of ``width`` bits whose Hamming distances tell all ``2 ** width`` values apart; greedy, the zero pattern first."""
    values = np.arange(1 << width, dtype=np.uint64)
    chosen, groups = [0], np.bitwise_count(values).astype(np.int64)
    while len(np.unique(groups)) < len(values):
        best, best_groups, most = 0, groups, 0
        for pattern in values.tolist():
            refined = groups * (width + 1) + np.bitwise_count(values ^ np.uint64(pattern))
            if (n := len(np.unique(refined))) > most:
                best, best_groups, most = pattern, refined, n
        chosen.append(best)
        groups = np.unique(best_groups, return_inverse=True)[1]
    return tuple(chosen)


@lru_cache(maxsize=8)
def block_references(blocks: int) -> tuple[tuple[int, ...], ...]:
    """Reference fingerprints of each block: a resolving set of its bits, zero outside."""
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    return tuple(tuple(p << low for p in resolving_set(high - low)) for low, high in zip(edges, edges[1:], strict=False))


@lru_cache(maxsize=4)
def spread_references(count: int = SPREAD_REFERENCES) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, count, dtype=np.uint64)


def distance_table(values: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Hamming distances (rows: fingerprints, columns: references)."""
    return np.bitwise_count(values[:, None] ^ references[None, :]).astype(np.int8)


def block_codes(values: np.ndarray, blocks: int) -> np.ndarray:
    """Each block's coordinates as one number (columns: blocks); equal numbers: no coordinate differs."""
    zero = np.bitwise_count(values).astype(np.int64)
    out = np.zeros((len(values), blocks), dtype=np.uint64)
    for b, references in enumerate(block_references(blocks)):
        for r in references[1:] + (references[1] ^ _mask(blocks, b),):
            out[:, b] = out[:, b] * np.uint64(131) + (np.bitwise_count(values ^ np.uint64(r)) - zero + 64).astype(np.uint64)
    return out


@lru_cache(maxsize=64)
def _mask(blocks: int, block: int) -> int:
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    return (1 << edges[block + 1]) - (1 << edges[block])


def plan_blocks(count: int, max_distance: int) -> tuple[int, int]:
    """Blocks and how many of them must agree, for ``count`` different fingerprints."""
    for kept in EXTRA_BLOCKS:
        blocks = max_distance + kept
        keys = len(list(combinations(range(blocks), kept)))
        if keys * count / 2.0 ** (64 * kept / blocks) <= CHANCE_PAIRS:
            break
    return blocks, kept


def _keyed(nodes: DataFrame, blocks: int, kept: int) -> DataFrame:
    """A row (key, node, fp) for each choice of ``kept`` blocks: the key is the choice and its coordinates."""
    choices = [list(c) for c in combinations(range(blocks), kept)]
    multipliers = np.random.default_rng(SEED + 1).integers(0, 2**63, (len(choices), kept + 1), dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp = batch.column("node").to_numpy(), batch.column("fp").to_numpy()
            codes = block_codes(fp.view(np.uint64), blocks)
            for choice, m in zip(choices, multipliers, strict=True):
                key = (codes[:, choice] * m[1:]).sum(axis=1, dtype=np.uint64) + m[0]
                key ^= key >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node), pa.array(fp)], ["key", "node", "fp"])

    return nodes.mapInArrow(run, "key bigint, node bigint, fp bigint")


def _forest(node: np.ndarray, fp: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one group: from each reached row to all rows not yet reached."""
    table = distance_table(fp, spread_references())
    rest, out = np.arange(len(fp)), []
    while len(rest):
        frontier, rest = [int(rest[0])], rest[1:]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.abs(table[rest, :4] - table[at, :4]).max(axis=1) <= max_distance
            near[near] = np.abs(table[rest[near]] - table[at]).max(axis=1) <= max_distance
            near[near] = np.bitwise_count(fp[rest[near]] ^ fp[at]) <= max_distance
            for i in rest[near].tolist():
                out.append((int(node[at]), int(node[i])))
                frontier.append(i)
            rest = rest[~near]
    return out


def _group_links(columns: list[np.ndarray], max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside each run of equal keys (rows sorted by the key columns)."""
    *keys, node, fp = columns
    fp = fp.view(np.uint64)
    same = np.ones(max(0, len(node) - 1), dtype=bool)
    for k in keys:
        same &= k[1:] == k[:-1]
    a, b = [], []
    ends = np.flatnonzero(np.concatenate([~same, [True]])) + 1
    begins = np.concatenate([[0], ends[:-1]])
    size = ends - begins
    two = begins[size == 2]
    references = spread_references()
    if len(two):
        near = np.abs(distance_table(fp[two], references) - distance_table(fp[two + 1], references)).max(axis=1) <= max_distance
        two = two[near]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_distance]
        a.append(node[two])
        b.append(node[two + 1])
    for i, j in zip(begins[size > 2].tolist(), ends[size > 2].tolist(), strict=True):
        if found := _forest(node[i:j], fp[i:j], max_distance):
            pairs = np.array(found, dtype=np.int64)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def links(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that connect all of ``nodes`` (node, fp: different fingerprints) within ``max_distance`` bits.

    Of each group that shares a key the links of a spanning forest, so that the components are those of all links.
    """
    blocks, kept = plan_blocks(nodes.count(), max_distance)
    keyed = _keyed(nodes, blocks, kept)
    sizes = keyed.groupBy("key").count().where("count > 1")
    parts = F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # rows of a large group: one copy for each pair of blocks that its own block belongs to
    split = (keyed.join(sizes.withColumn("parts", parts).drop("count").withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
             .select("key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"), "node", "fp")
             .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            # the last group may go on in the next batch
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]) | (now[2] != now[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in now]
            yield _as_batch(*_group_links([c[:cut] for c in now], max_distance))
        if held is not None:
            yield _as_batch(*_group_links(held, max_distance))

    return (split.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInArrow(run, "a bigint, b bigint"))


def _as_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id among the rows whose fingerprint can be reached by links, the row's own included.
    Only fingerprints are linked: rows of one doc_id with different texts belong to the components of their fingerprints,
    which that doesn't join.  Null and empty texts have fingerprint 0 and link like any other; rows with a null doc_id get
    the component of their fingerprint, null if no row of the component has an id.  Repeated rows stay repeated.
    """
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle_words).select("doc_id", "fp"), "simhash")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")).select("fp", F.col("fp").alias("node"), "least"), "simhash-nodes")
    found = components(links(nodes.select("fp", "node"), max_distance), "simhash-links")
    classes = nodes.join(found, "node", "left").select(
        F.col("fp").alias("f"), "least", F.coalesce("component", "node").alias("class_id"))
    smallest = classes.groupBy("class_id").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "class_id").select("f", "component_id")
    return prints.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with one row of each component: that of the smallest doc_id.

    Components are of fingerprints: rows that share a doc_id but not their fingerprint are joined by bit distance only.
    Of rows with the smallest doc_id the smallest fingerprint stays, once; a component without any doc_id keeps one row too.
    """
    names = docs.columns
    texts = docs.withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text", "text_hash")
    prints = written(fingerprints(texts, shingle_words).select("doc_id", "text_hash", "fp"), "simhash")
    # of each fingerprint the row with the smallest id, and of equal ids the smallest hash
    ordered = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash")
    nodes = written(prints.groupBy("fp").agg(F.min(ordered).alias("row")).select("fp", F.col("fp").alias("node"), "row"), "simhash-nodes")
    found = components(links(nodes.select("fp", "node"), max_distance), "simhash-links")
    chosen = (nodes.join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("class_id"))
              .agg(F.min("row").alias("row")).select(F.col("row.doc_id").alias("chosen_id"), F.col("row.text_hash").alias("chosen_hash")))
    chosen = written(chosen, "simhash-chosen")
    same = docs["doc_id"].eqNullSafe(chosen["chosen_id"]) & (F.xxhash64(docs["text"]) == chosen["chosen_hash"])
    # rows of equal id and text are copies
    kept = docs.join(chosen, same, "left_semi").withColumn("__text_hash", F.xxhash64("text"))
    return kept.dropDuplicates(["doc_id", "__text_hash"]).select(*names)
