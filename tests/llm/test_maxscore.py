import random

import duckdb
import numpy as np
import pytest

from tickframe.llm import catalog
from tickframe.llm import maxscore as M

VECTOR = "vec_id bigint, embedding array<float>"
NAN = float("nan")


def plain(rows, k):
    """Every twentieth id against all others, by definition."""
    whole = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        w = [int(x) for x in np.floor(64 * np.array(v, dtype=np.float32).astype(float))]
        whole[i] = min(whole.get(i, w), w)
    return {q: sorted((-sum(a * b for a, b in zip(x, v, strict=False)), i) for i, v in whole.items() if i != q)[:k]
            for q, x in whole.items() if q % 20 == 0}


def searched(workers, rows, k):
    vectors = M.quantised(workers.createDataFrame(rows, VECTOR).selectExpr("*", "'x' AS weights", "7 AS score"))
    found = {}
    for r in M.top_k(vectors, vectors.where("vec_id % 20 = 0"), k).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (-r["score"], r["vec_id"])
    return {q: [f[r] for r in range(1, len(f) + 1)] for q, f in found.items()}


def test_a_shard_equals_all_products():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n, dims, k = rng.integers(1, 60), rng.integers(1, 7), int(rng.integers(1, 6))
        rows = rng.integers(-4, 5, (n, dims))
        rows[rng.random((n, dims)) < 0.6] = 0
        ids, query = rng.permutation(200)[:n], rng.integers(-4, 5, dims)
        own = int(rng.choice(ids))
        want = sorted((-int(s), int(i)) for s, i in zip(rows @ query, ids, strict=True) if i != own)[:k]
        needed = M.LEAST if len(want) < k or rng.random() < 0.3 else -want[-1][0] - int(rng.integers(0, 3))
        at, scores = M.Shard(ids, rows).search(query, own, k, int(needed), bool(rng.random() < 0.5))
        assert [(-int(s), int(ids[a])) for a, s in zip(at, scores, strict=True)] == want


def test_non_essential_terms_are_not_traversed():
    """A row that only small terms name is never scored: its posting isn't even read."""
    rows = np.zeros((100, 3), dtype=np.int64)
    rows[:50, 0], rows[50:, 1], rows[:, 2] = 10, 1, 1
    shard = M.Shard(np.arange(100), rows)
    shard.postings[1] = shard.postings[2] = None  # reading them would fail
    at, scores = shard.search(np.array([1, 1, 1]), -1, 5, 10, True)
    assert at.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [11] * 5


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    own = [(i, rng.normal(0, 0.2, 12).tolist()) for i in range(500)]
    hot = rng.normal(0, 0.3, 12).tolist()
    own += [(1000 + i, hot) for i in range(300)]  # a vector that a third of all rows have
    own += [(2000, None), (2020, [NAN] * 12), (2040, [0.1, None]), (2060, [float("inf")]), (2080, []), (2100, [0.5]), (None, [1.0] * 12)]
    return own + [(20, own[20][1]), (40, [0.9] * 12), (2120, [0.0] * 12), (2140, [9.0] * 14)]


def test_search_in_many_shards(workers, rows, monkeypatch):
    monkeypatch.setattr(M, "SHARD_BYTES", 12 * 8 * 150)
    monkeypatch.setattr(M, "QUERY_BLOCK_BYTES", 12 * 8 * 15)
    monkeypatch.setattr(M, "PILOT_ROWS", 60)
    assert searched(workers, rows, 7) == plain(rows, 7)


def test_few_rows_and_none(workers, rows):
    assert searched(workers, rows[:3], 20) == plain(rows[:3], 20)
    assert searched(workers, rows[:1], 20) == {} and searched(workers, [], 20) == {} and searched(workers, [(20, None)], 20) == {}


def test_products_that_do_not_fit_are_an_error(workers):
    with pytest.raises(Exception, match="do not fit a long"):
        searched(workers, [(0, [1e9]), (1, [1e9]), (2, [-1e9])], 1)


def test_query_equals_its_sql(workers, tmp_path):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(300)] + [(300, None), (301, [NAN] * 16)]
    workers.createDataFrame(rows, VECTOR).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = catalog.op12_maxscore(workers, str(tmp_path))
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = con.execute(catalog.llm_oracles()["op12_maxscore"]).fetchall()
    assert len(want) == 15 * 20 and sorted(map(tuple, found.collect())) == sorted(want)
