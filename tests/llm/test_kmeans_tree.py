import numpy as np
import pytest

from tickframe.llm import kmeans_tree as K

VECTOR = "vec_id bigint, embedding array<float>"


def plain(rows, queries, k):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8]
    out = {}
    for q, x in good:
        if q in queries:
            scored = sorted((-K.cosines(x, v[None])[0], i) for i, v in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 8))
    own = [(i, (centres[rng.integers(25)] + 0.3 * rng.normal(size=8)).tolist()) for i in range(1500)]
    same = rng.normal(size=8).tolist()
    own += [(2000 + i, same) for i in range(400)]
    nan = float("nan")
    return own + [(3000, None), (3050, [0.0] * 8), (3100, [nan] * 8), (3150, [1.0, None] * 4), (3200, [float("inf")] + [1.0] * 7),
                  (3250, []), (3300, [1.0] * 5), (None, [1.0] * 8), (3350, (np.array(same) * 3).tolist())]


def search(workers, rows, k=5, **options):
    frame = workers.createDataFrame(rows, VECTOR).selectExpr("*", "1 AS leaf")
    found = {}
    for r in K.neighbours(frame, frame.where("vec_id % 50 = 0"), k, **options).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    return found


def test_recall_and_exact_scores(workers, rows, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(K, "BLOCK_QUERIES", 5)
    queries = {i for i, _ in rows if i is not None and i % 50 == 0}
    want, found = plain(rows, queries, 5), search(workers, rows, sample_rows=800)
    assert set(found) == set(want)
    hits = total = 0
    for q, true in want.items():
        got = [found[q][r] for r in sorted(found[q])]
        assert sorted(found[q]) == [1, 2, 3, 4, 5] and got == sorted(got, key=lambda x: (-x[1], x[0]))
        exact = dict(rows)
        for v, s in got:
            a, b = (np.array(exact[i], dtype=np.float32).astype(float) for i in (q, v))
            assert np.isclose(s, a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), atol=1e-12, rtol=0)
        hits += len({v for v, _ in got} & {v for v, _ in true})
        total += len(true)
    assert hits / total >= 0.9
    assert [v for v, _ in sorted(found[2000].values(), key=lambda x: (-round(x[1], 9), x[0]))][0] == 2001


def test_tree_covers_all_leaves_and_visits_each_once(rows):
    unit = K._unit(np.array([v for i, v in rows[:1500]]))
    tree = K.fit_tree(unit, min_leaf=20)
    assert tree.leaves > 10
    for u in unit[:10]:
        order = list(tree.visits(u))
        assert sorted(order) == list(range(tree.leaves)) and order[0] == tree.leaf_of(u[None])[0]


def test_rows_of_one_id_are_one_vector(workers):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, [1.0, 0.5]), (50, [0.0, 1.0]), (50, [0.5, 1.0]), (3, [None, 1.0]), (3, [0.1, 1.0])]
    found = {q: [r[k][0] for k in sorted(r)] for q, r in search(workers, rows).items()}
    assert found == {0: [1, 2, 3, 50], 50: [3, 2, 1, 0]}


def test_few_rows_and_none(workers):
    found = search(workers, [(0, [1.0] * 8), (1, [1.0] * 7 + [0.0]), (2, None)])
    assert {q: [v for v, _ in r.values()] for q, r in found.items()} == {0: [1]}
    assert search(workers, [(0, [1.0] * 8)]) == {} and search(workers, []) == {}
