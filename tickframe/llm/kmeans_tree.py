"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample of unit vectors: each node splits its
vectors into ``BRANCHES`` clusters until few are left.  Every vector is indexed:
it belongs to the leaf that the nearest child leads to at each node.  A query
walks the tree best bin first: a priority queue holds the children not taken, by
their distance, and yields the next leaf to visit.  How many leaves a query
visits is calibrated: for a bounded number of calibration queries the true
neighbours are found by comparing them with all vectors, and the number is the
smallest that reaches the target recall.

Vectors meet queries by leaf.  A leaf with many vectors or many queries is dealt
out over blocks of bounded size, so that a vector that a third of all rows have
in common lands in many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm._common import written

SAMPLE_ROWS = 20_000
BRANCHES = 8
MIN_LEAF_SAMPLE = 40
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.97
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 1024


@dataclass
class Tree:
    """Centroids of each inner node's children, and where they lead: a node's number, or ~leaf."""

    centroids: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        out = np.zeros(len(unit), dtype=np.int64)
        todo = [(0, np.arange(len(unit)))] if self.centroids else []
        while todo:
            node, rows = todo.pop()
            nearest = _nearest(unit[rows], self.centroids[node])
            for k, child in enumerate(self.children[node]):
                own = rows[nearest == k]
                if child < 0:
                    out[own] = ~child
                elif len(own):
                    todo.append((child, own))
        return out

    def visits(self, unit: np.ndarray) -> Iterator[int]:
        """Leaves for a query, best bin first."""
        if not self.centroids:
            yield 0
            return
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while node >= 0:  # down to a leaf; the other children wait in the queue
                far = ((self.centroids[node] - unit) ** 2).sum(axis=1)
                order = np.argsort(far, kind="stable").tolist()
                for k in order[1:]:
                    heapq.heappush(queue, (float(far[k]), self.children[node][k]))
                node = self.children[node][order[0]]
            yield ~node


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * points @ centroids.T).argmin(axis=1)


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centroids = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(points, centroids)
        for j in range(k):
            if (members := points[own == j]).size:
                centroids[j] = members.mean(axis=0)
    return centroids, _nearest(points, centroids)


def fit_tree(sample: np.ndarray, branches: int = BRANCHES, min_leaf: int = MIN_LEAF_SAMPLE, seed: int = 3) -> Tree:
    """A tree over the different rows of ``sample`` (unit vectors)."""
    rng, tree = np.random.default_rng(seed), Tree([], [], 1)
    points = np.unique(sample, axis=0) if len(sample) else sample
    if len(points) < 2 * min_leaf:
        return tree
    tree.leaves = 0
    todo: list[tuple[np.ndarray, int, int]] = [(points, -1, 0)]  # vectors, parent, place among its children
    while todo:
        own, parent, place = todo.pop()
        centroids, nearest = (None, None)
        if len(own) >= 2 * min_leaf:
            centroids, nearest = _k_means(own, min(branches, len(own) // min_leaf), rng)
            used = np.unique(nearest)
            centroids, nearest = centroids[used], np.searchsorted(used, nearest)
        if centroids is None or len(centroids) < 2:
            number, tree.leaves = ~tree.leaves, tree.leaves + 1
        else:
            number = len(tree.centroids)
            tree.centroids.append(centroids)
            tree.children.append([0] * len(centroids))
            todo += [(own[nearest == k], number, k) for k in range(len(centroids))]
        if parent >= 0:
            tree.children[parent][place] = number
    if not tree.centroids:
        tree.leaves = 1
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of one vector with many, each summed in the same order, so that equal vectors have equal cosines."""
    with np.errstate(over="ignore"):
        return (vectors * query).sum(axis=1) / (np.sqrt((query * query).sum()) * np.sqrt((vectors * vectors).sum(axis=1)))


def _best(query: np.ndarray, own: int, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ``k`` nearest to the query, and their cosines; ``near``: cosines up to rounding."""
    rows = np.flatnonzero(ids != own)
    if len(rows) > k:
        least = np.partition(near[rows], len(rows) - k)[len(rows) - k]
        rows = rows[near[rows] >= least - 1e-9]
    exact = cosines(query, vectors[rows])
    order = np.lexsort((ids[rows], -exact))[:k]
    return rows[order], exact[order]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding: array<double>) of the rows that take part.

    Left out: null vec_id, null or empty vectors, null or non-finite components, zero vectors, and vectors of another
    length than most.
    """
    own = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = own.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & some)
    sizes = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.where(F.size("embedding") == (sizes[0]["n"] if sizes else 0))


def calibrated(vectors: DataFrame, tree: Tree, queries: list[tuple[int, np.ndarray]], k: int, target: float) -> tuple[int, float]:
    """The smallest number of leaves whose recall over ``queries`` is at least ``target``, and that recall.

    The true neighbours come from comparing the queries (a bounded number) with every vector.
    """
    if not queries or tree.leaves == 1:
        return tree.leaves, 1.0
    ids, points = np.array([i for i, _ in queries]), np.array([v for _, v in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit(points)
        for batch in batches:
            own, vecs = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            if not len(own):
                continue
            near, leaf, out = units @ _unit(vecs).T, tree.leaf_of(_unit(vecs)), []
            for q in range(len(ids)):
                rows, exact = _best(points[q], ids[q], own, vecs, near[q], k)
                out += zip([q] * len(rows), own[rows].tolist(), exact.tolist(), leaf[rows].tolist(), strict=True)
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(("q", "vec_id", "score", "leaf"), zip(*out, strict=True), strict=True)})

    found = vectors.mapInArrow(run, "q bigint, vec_id bigint, score double, leaf bigint")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    truth = found.withColumn("r", rank).where(F.col("r") <= k).collect()  # k rows per calibration query
    place = [{leaf: n for n, leaf in enumerate(tree.visits(u), 1)} for u in _unit(points)]
    needed = np.sort([place[t["q"]][t["leaf"]] for t in truth])
    if not len(needed):
        return tree.leaves, 1.0
    visits = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])
    return visits, float((needed <= visits).mean())


def _one_each(vectors: DataFrame) -> DataFrame:
    return usable(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, sample_rows: int = SAMPLE_ROWS,
               target: float = TARGET_RECALL) -> DataFrame:
    """The ``k`` nearest by cosine of each query (query_id, rank from 1, vec_id, score).

    ``vectors`` (vec_id, embedding) are all indexed; ``queries`` has rows of the same kind, and a query's own vec_id is no
    candidate.  Ties go to the smaller vec_id.  A query with fewer candidates gets all of them.  Rows that can't take part
    (see ``usable``) are left out on both sides.  Rows of one vec_id are one vector: the smallest of those that can take part,
    in the order of its components.  The tree's sample: the ``sample_rows`` rows with the smallest hash of vec_id.
    """
    spark = vectors.sparkSession
    base = written(_one_each(vectors), "ann-vectors")
    sampled = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    points = np.array([r["embedding"] for r in sampled])
    tree = fit_tree(_unit(points) if len(points) else np.zeros((0, 1)))
    chosen = np.random.default_rng(5).permutation(len(points))[:CALIBRATION_QUERIES]
    visits, _ = calibrated(base, tree, [(sampled[i]["vec_id"], points[i]) for i in chosen], k, target)
    shared = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.leaf_of(_unit(_matrix(batch.column("embedding")))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec_id", "embedding"])

    indexed = written(base.select("vec_id", "embedding").mapInArrow(index, "leaf bigint, vec_id bigint, embedding array<double>"), "ann-index")
    in_leaf = indexed.groupBy("leaf").count()
    sizes = {r["leaf"]: r["count"] for r in in_leaf.collect()}  # a row per leaf

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaves, at = batch.column("vec_id"), [], []
            for i, unit in enumerate(_unit(_matrix(batch.column("embedding"))) if batch.num_rows else []):
                seen = 0
                for n, leaf in enumerate(shared.value.visits(unit)):
                    if n >= visits and seen > k:  # also until there are enough candidates
                        break
                    if sizes.get(leaf):
                        seen += sizes[leaf]
                        leaves.append(leaf)
                        at.append(i)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), ids.take(rows), batch.column("embedding").take(rows)],
                                             ["leaf", "query_id", "query"])

    asked = _one_each(queries).join(base.select(F.col("vec_id").alias("v")).distinct(), F.col("vec_id") == F.col("v"), "left_semi")
    asked = written(asked.select("vec_id", "embedding")
                    .mapInArrow(search, "leaf bigint, query_id bigint, query array<double>"), "ann-queries")
    blocks = (in_leaf.withColumnRenamed("count", "n").join(asked.groupBy("leaf").count().withColumnRenamed("count", "m"), "leaf")
              .select(F.col("leaf").alias("l"), F.ceil(F.col("n") / BLOCK_VECTORS).cast("int").alias("vector_blocks"),
                      F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("query_blocks")))

    def dealt(rows: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        both = rows.join(blocks, F.col("leaf") == F.col("l"))
        return (both.withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).select(*rows.columns, "vector_block", "query_block"))

    keys = ["leaf", "vector_block", "query_block"]
    left = dealt(indexed, "vec_id", "vector_block", "query_block").groupBy(*keys)
    right = dealt(asked, "query_id", "query_block", "vector_block").groupBy(*keys)

    def compare(own: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        if own.num_rows and asking.num_rows:
            ids, vecs = own.column("vec_id").to_numpy(), _matrix(own.column("embedding").combine_chunks())
            qids, qvecs = asking.column("query_id").to_numpy(), _matrix(asking.column("query").combine_chunks())
            near = _unit(qvecs) @ _unit(vecs).T
            for q in range(len(qids)):
                rows, exact = _best(qvecs[q], qids[q], ids, vecs, near[q], k)
                out += zip([int(qids[q])] * len(rows), ids[rows].tolist(), exact.tolist(), strict=True)
        columns = zip(*out, strict=True) if out else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"])

    found = left.cogroup(right).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
