"""Exact top-k search by inner product over postings, with MaxScore.

A vector of whole numbers is a document whose terms are its dimensions: the
posting list of a dimension holds the rows with a weight there.  The index is
cut into shards of bounded size.  In a shard, a term of a query has a score
bound: the largest contribution that any row of the shard gets from it.  Terms
in order of their bounds are split: as many of the smallest as can't lift a row
to the score that the query needs by themselves are non-essential.  Only the
postings of the others, the essential ones, are traversed; the non-essential
terms are probed, largest bound first, for those rows whose sum so far plus the
bounds left is still competitive.  What a query needs at least is known before
it meets the first shard: its k-th best score among a bounded set of pilot
rows; in a shard the exact scores of the best rows so far raise it.

Shards and blocks of queries meet as groups of bounded size, dealt by a hash of
the id, so that a vector that many rows have in common lies in all shards.
Every shard returns at most k rows a query; one window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm._common import written

SHARD_BYTES = 8 << 20
QUERY_BLOCK_BYTES = 2 << 20
PILOT_ROWS = 2048
PILOT_BYTES = 8 << 20
#: Rows that are scored to the end at once, in place of term by term, as a multiple of k.
FINISH = 8
LEAST = np.iinfo(np.int64).min
EXACT_IN_DOUBLE = 2.0**53


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """``floor(scale * x)`` of each component: (vec_id, weights).

    Vectors that are null or hold a null or non-finite component are left out, as are rows without vec_id.  Rows of one
    vec_id are one vector: the smallest in the order of its components.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    x = F.col("embedding").cast("array<double>")
    usable = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, finite))
    whole = usable.select("vec_id", F.transform(x, lambda c: F.floor(F.lit(scale) * c)).alias("weights"))
    return whole.groupBy("vec_id").agg(F.min("weights").alias("weights"))


def matrix(weights: pa.Array, dims: int) -> np.ndarray:
    """One row per vector; a vector that ends early has no weight in the dimensions behind."""
    lengths = weights.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(weights), dims), dtype=np.int64)
    out[np.arange(dims) < lengths[:, None]] = weights.flatten().to_numpy(zero_copy_only=False)
    return out


def checked(rows: np.ndarray, queries: np.ndarray) -> bool:
    """Whether sums of products are exact as doubles; an error where they don't even fit 64 bits."""
    largest = [float(np.abs(m).max(initial=0)) for m in (rows, queries)]
    bound = largest[0] * largest[1] * max(rows.shape[1], 1)
    if bound >= 2.0**62:
        raise OverflowError(f"inner products of up to {bound:.3g} do not fit a long: use a smaller scale")
    return bound < EXACT_IN_DOUBLE


def products(rows: np.ndarray, query: np.ndarray, as_double: bool) -> np.ndarray:
    if as_double:
        return np.rint(rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return rows @ query


class Shard:
    """Postings of some rows: by dimension, the rows that have a weight there, and the weights."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.columns = np.ascontiguousarray(rows.T)
        self.largest = self.columns.max(axis=1, initial=0)  # a row without the term has no contribution
        self.smallest = self.columns.min(axis=1, initial=0)
        self.postings = []
        for column in self.columns:
            listed = np.flatnonzero(column)
            # a term of most rows is kept as a full column
            self.postings.append((None, column) if 2 * len(listed) > len(ids) else (listed, column[listed]))

    def search(self, query: np.ndarray, own: int, k: int, needed: int, as_double: bool) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the best ``k`` that reach ``needed``, best first, ties to the smaller id; never the row ``own``."""
        bounds = np.where(query > 0, query * self.largest, query * self.smallest)
        order = np.argsort(bounds, kind="stable")
        order = order[bounds[order] > 0] if needed > 0 else order[query[order] != 0]
        reach = np.cumsum(bounds[order])
        split = int(np.searchsorted(reach, needed)) if needed > 0 else 0  # terms before it reach less than what is needed
        essential, others = order[split:][::-1], order[:split][::-1]
        total, listed = np.zeros(len(self.ids), dtype=np.int64), np.zeros(len(self.ids), dtype=bool)
        if needed <= 0:
            listed[:] = True  # a row without any of the terms has 0
        for term in essential:
            at, weights = self.postings[term]
            if at is None:
                total += query[term] * weights
                listed[:] = True
            else:
                total[at] += query[term] * weights
                listed[at] = True
        # terms without a positive bound only lower a score: they are left to the exact sums
        left = int(reach[split - 1]) if split else 0
        rows = np.flatnonzero(listed & (total + left >= needed) & (self.ids != own))
        if len(rows) > FINISH * k:
            best = rows[np.argpartition(total[rows], len(rows) - k)[-k:]]
            needed = max(needed, int(products(self.rows[best], query, as_double).min()))
            rows = rows[total[rows] + left >= needed]
        partial = total[rows]
        for term in others:
            if len(rows) <= FINISH * k:
                break
            partial = partial + query[term] * self.columns[term][rows]
            left -= int(bounds[term])
            still = partial + left >= needed
            rows, partial = rows[still], partial[still]
        scores = products(self.rows[rows], query, as_double)
        rows, scores = rows[scores >= needed], scores[scores >= needed]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest inner products of each query: (query_id, rank from 1, vec_id, score).

    Both sides are (vec_id, weights) with one row per vec_id, weights an array of longs without nulls (see ``quantised``).
    Candidates of a query are all rows but that of its own vec_id; fewer than ``k`` of them are all returned.  Ties go to
    the smaller vec_id.  Vectors of different lengths meet as if zeros followed; an empty vector has the score 0 with all.
    Other columns are ignored.  Without queries or candidates there are no rows.
    """
    spark = vectors.sparkSession
    base, asked = written(vectors.select("vec_id", "weights"), "maxscore-rows"), queries.select("vec_id", "weights")
    count, dims = base.agg(F.count("*"), F.coalesce(F.max(F.size("weights")), F.lit(0))).first()
    asked_dims = asked.agg(F.coalesce(F.max(F.size("weights")), F.lit(0))).first()[0]
    dims = max(int(dims), int(asked_dims), 1)
    pilots = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(k + 1, min(PILOT_ROWS, PILOT_BYTES // (8 * dims)))).toArrow()
    shared = spark.sparkContext.broadcast((  # bounded by PILOT_BYTES
        pilots.column("vec_id").to_numpy(), matrix(pilots.column("weights").combine_chunks(), dims)))

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = shared.value
        for batch in batches:
            needed = np.full(batch.num_rows, LEAST)
            points = matrix(batch.column("weights"), dims)
            as_double = checked(rows, points)
            for i, own in enumerate(batch.column("vec_id").to_pylist()):
                scores = products(rows[ids != own], points[i], as_double)
                if len(scores) >= k:
                    needed[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("weights"), pa.array(needed)],
                                             ["query_id", "query", "needed"])

    asked = written(asked.mapInArrow(floored, "query_id bigint, query array<bigint>, needed bigint"), "maxscore-queries")
    shards = max(1, -(-count * dims * 8 // SHARD_BYTES))
    blocks = max(1, -(-asked.count() * dims * 8 // QUERY_BLOCK_BYTES))

    def dealt(rows: DataFrame, key: str, own: str, parts: int, other: str, others: int) -> DataFrame:
        """Each row in one part of its own side, once for each part of the other."""
        return (rows.withColumn(own, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    left = dealt(base, "vec_id", "shard", shards, "block", blocks).groupBy("shard", "block")
    right = dealt(asked, "query_id", "block", blocks, "shard", shards).groupBy("shard", "block")

    def search(held: pa.Table, asking: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if held.num_rows and asking.num_rows:
            points = matrix(asking.column("query").combine_chunks(), dims)
            shard = Shard(held.column("vec_id").to_numpy(), matrix(held.column("weights").combine_chunks(), dims))
            as_double = checked(shard.rows, points)
            needed = asking.column("needed").to_numpy()
            for i, own in enumerate(asking.column("query_id").to_pylist()):
                rows, scores = shard.search(points[i], own, k, int(needed[i]), as_double)
                out.append((np.full(len(rows), own), shard.ids[rows], scores))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
