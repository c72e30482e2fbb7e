"""Sequence packing as a cutting-stock problem, solved by column generation.

Documents are cut into full pieces of ``capacity`` tokens and one remainder
(cuts stay at multiples of the capacity, so a short document is never cut).
Remainders are counted in length classes of ``GRAIN`` tokens; a pattern says how
many of each class share a sequence.  The linear program over patterns starts
with one pattern per class; its dual values price new patterns, and a knapsack
by dynamic programming finds the best of them, until none improves the program.
Patterns are used as often as whole numbers allow, what remains is solved again,
and the last few pieces are packed by decreasing length.

The program sees one number per length class, so it is as large for a thousand
documents as for a trillion.  Pieces are ranked in their class by counts per
task and prefix sums; rank and plan give each piece its sequence and place, so
no task sees more than its share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm._common import runs_of, written
from tickframe.llm._tokens import default_tokenizer, encoder

CAPACITY = 2048
GRAIN = 8
#: Column generation ends when the program is proven to be within this share of its optimum, or after so many columns a class.
GAP = 0.002
COLUMNS_PER_CLASS = 8
ROUNDS = 2
END_ID = 1
BATCH_BYTES = 8_000_000

_PIECES = "task int, klass int, nth bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def price(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern of classes 1.. (class k takes k units) within ``capacity`` units."""
    size = np.flatnonzero(values > 0) + 1
    worth = values[size - 1]
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    fitting = np.searchsorted(size, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fitting[room]:
            gains = worth[:n] + best[room - size[:n]]
            k = gains.argmax()
            if gains[k] > best[room]:
                best[room], take[room] = gains[k], size[k]
    pattern, room = np.zeros(len(values), dtype=np.int64), capacity
    while room > 0:
        if take[room]:
            pattern[take[room] - 1] += 1
            room -= int(take[room])
        else:
            room -= 1
    return float(best[capacity]), pattern


def solve_relaxed(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used (fractions) so that every class meets its demand, by column generation."""
    rows = np.flatnonzero(demand)
    need = demand[rows].astype(float)
    # a basis column is a pattern (cost 1) or the surplus of a class (cost 0, pattern -1)
    basis = np.zeros((len(rows), len(demand)), dtype=np.int64)
    basis[np.arange(len(rows)), rows] = capacity // (rows + 1)
    cost = np.ones(len(rows))
    inverse = np.diag(1.0 / basis[np.arange(len(rows)), rows])
    used = inverse @ need
    bound = float(np.arange(1, len(demand) + 1) @ demand) / capacity
    for step in range(COLUMNS_PER_CLASS * len(rows)):
        duals = np.zeros(len(demand))
        duals[rows] = cost @ inverse
        if duals.min() < -1e-9:
            pattern, price_of = np.zeros(len(demand), dtype=np.int64), 0.0
            pattern[duals.argmin()] = -1
        else:
            value, pattern = price(duals, capacity)
            bound = max(bound, float(duals[rows] @ need) / max(value, 1))  # no solution of the program can be smaller
            price_of = 1.0
            if cost @ used <= bound * (1 + GAP) or value <= 1 + 1e-7:
                break
        column = inverse @ pattern[rows]
        grows = np.flatnonzero(column > 1e-9)
        if not len(grows):
            break
        ratio = used[grows] / column[grows]
        out = grows[np.flatnonzero(ratio <= ratio.min() + 1e-12)[-1]] if step % 2 else grows[ratio.argmin()]
        share = used[out] / column[out]
        used = np.maximum(used - share * column, 0)
        used[out] = share
        inverse[out] /= column[out]
        others = np.arange(len(rows)) != out
        inverse[others] -= np.outer(column[others], inverse[out])
        basis[out], cost[out] = pattern, price_of
        if step % 100 == 99:  # against rounding errors of the updates
            inverse = np.linalg.inv(basis[:, rows].T.astype(float))
            used = np.maximum(inverse @ need, 0)
    return basis[cost > 0], used[cost > 0]


def plan(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns with whole numbers of uses that take exactly ``demand`` pieces of each class (class k takes k + 1 units)."""
    left, out = demand.astype(np.int64).copy(), []
    for _ in range(ROUNDS):
        if not left.any():
            break
        patterns, used = solve_relaxed(left, capacity)
        placed = False
        for rounding in (np.floor(used + 1e-9), np.ceil(used - 1e-9)):
            for i in np.argsort(-(used - np.floor(used)), kind="stable").tolist():
                wanted = patterns[i] > 0
                if rounding[i] > 0 and wanted.any():
                    times = int(min(rounding[i], (left[wanted] // patterns[i][wanted]).min()))
                    if times > 0:
                        out.append((patterns[i].copy(), times))
                        left -= times * patterns[i]
                        placed = True
                        used[i] -= times
        if not placed:
            break
    while left.any():  # less than one sequence per pattern is left: the longest that fit, again and again
        pattern, room = np.zeros_like(left), capacity
        for k in np.flatnonzero(left)[::-1].tolist():
            pattern[k] = min(int(left[k]), room // (k + 1))
            room -= int(pattern[k]) * (k + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        out.append((pattern, times))
        left -= times * pattern
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of each document, with its class and its number among the task's pieces of that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        counts = np.zeros(-(-capacity // GRAIN) + 1, dtype=np.int64)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").fill_null("")
            for part in runs_of(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                doc, start, length, crc, total = [], [], [], [], []
                for i, raw in enumerate(enc.encode(texts.slice(part.start, part.stop - part.start)), part.start):
                    tokens = np.append(np.frombuffer(raw, dtype=enc.dtype), enc.dtype.type(end_id)).astype("<u4")
                    for at in range(0, len(tokens), capacity):
                        piece = tokens[at:at + capacity]
                        doc.append(i)
                        start.append(at)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(tokens))
                klass = -(-np.array(length, dtype=np.int64) // GRAIN)
                order = np.argsort(klass, kind="stable")
                sizes = np.bincount(klass, minlength=len(counts))
                nth = np.empty(len(klass), dtype=np.int64)
                nth[order] = np.arange(len(klass)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + counts[klass[order]]
                counts += sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(klass), task, dtype=np.int32)), pa.array(klass.astype(np.int32)), pa.array(nth),
                     ids.take(pa.array(doc, pa.int64())).cast(pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array(total, pa.int64())],
                    ["task", "klass", "nth", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, _PIECES)


def _assigned(ranked: DataFrame, patterns: list[tuple[np.ndarray, int]]) -> DataFrame:
    """Sequence and slot of each piece from its class and rank.  The plan has an entry per pattern and class in it."""
    first = np.concatenate([[0], np.cumsum([times for _, times in patterns])]).astype(np.int64)
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    for number, (pattern, times) in enumerate(patterns):
        slot = 0
        for k in np.flatnonzero(pattern)[::-1].tolist():
            each = int(pattern[k])
            entries.setdefault(k + 1, []).append((taken.get(k + 1, 0), int(first[number]), each, slot))
            taken[k + 1] = taken.get(k + 1, 0) + times * each
            slot += each
    table = {k: np.array(own, dtype=np.int64) for k, own in entries.items()}
    names = [f.name for f in ranked.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            klass, rank = batch.column("klass").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for k in np.unique(klass).tolist():
                own = klass == k
                entry = table[k][np.searchsorted(table[k][:, 0], rank[own], side="right") - 1]
                local = rank[own] - entry[:, 0]
                sequence[own] = entry[:, 1] + local // entry[:, 2]
                slot[own] = entry[:, 3] + local % entry[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(slot)], [*names, "sequence_id", "slot"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields)
    return ranked.mapInArrow(run, f"{fields}, sequence_id bigint, slot bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document's ids are followed by ``end_id``; a null or empty text is that id alone.  Sequences are numbered from 0
    and filled without gaps.  Rows of equal doc_id, or without one, are packed each for itself.
    """
    if capacity % GRAIN:
        raise ValueError(f"capacity must be a multiple of {GRAIN}")
    cut = written(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "packing-pieces")
    by_task = cut.groupBy("task", "klass").count()
    demand = np.zeros(-(-capacity // GRAIN), dtype=np.int64)
    for row in by_task.groupBy("klass").agg(F.sum("count").alias("n")).collect():  # a row per length class
        demand[row["klass"] - 1] = row["n"]
    patterns = plan(demand, capacity // GRAIN)
    before = F.sum("count").over(W.partitionBy("klass").orderBy("task")) - F.col("count")
    bases = by_task.select(F.col("task").alias("t"), F.col("klass").alias("k"), before.alias("before"))
    ranked = (cut.join(bases, (F.col("task") == F.col("t")) & (F.col("klass") == F.col("k")))
              .withColumn("rank", F.col("before") + F.col("nth"))
              .select("klass", "rank", "doc_id", "start", "length", "ids_crc32", "doc_tokens"))
    placed = _assigned(ranked, patterns)
    ahead = F.sum("length").over(W.partitionBy("sequence_id").orderBy("slot")) - F.col("length")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", ahead.alias("offset"))
