import hashlib
import random
import zlib

import numpy as np
import pytest

from tickframe.llm import catalog
from tickframe.llm import periodic_runs as P


def plain_runs(words):
    """(start, length, period) of all runs, every period tried at every place."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), s, m, q, 1000 * m // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def words_with_runs(rng, n, letters):
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        p, s = rng.randrange(1, max(2, n // 2)), rng.randrange(max(n, 1))
        for i in range(s + p, min(n, s + rng.randrange(2 * p + 12) + p)):
            words[i] = words[i - p]
    return words


def test_groups_of_sequences_equal_the_definition():
    rng = random.Random(4)
    for _ in range(700):
        texts = [[b"%d" % w for w in words_with_runs(rng, rng.randrange(0, 130), rng.choice([1, 2, 3, 6, 30]))] for _ in range(rng.randrange(1, 5))]
        columns, collapsed = P._results(texts)
        for words, runs, left in zip(texts, columns[5].to_pylist(), collapsed, strict=True):
            want = plain_runs(words)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want
            gone = {i for s, m, q in want for i in range(s + q, s + m)}
            assert left == b" ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 30, 31, 32, 62, 63, 100])
def test_every_start_of_the_shortest_run(period):
    """At each offset to the blocks, for periods on both sides of each level's bounds."""
    length = max(12, 2 * period)
    for start in range(70):
        inner = [1000 + i % period for i in range(length)]
        symbols = np.array([*range(start), *inner, *range(2000, 2070)])
        symbols = np.unique(symbols, return_inverse=True)[1]
        assert P.runs_in(symbols).tolist() == [[start, start + length, period]]
        assert len(P.runs_in(np.delete(symbols, start))) == 0


def test_suffix_array_and_wavelet_matrix():
    rng = np.random.default_rng(2)
    for _ in range(60):
        symbols = np.append(rng.integers(0, 3, rng.integers(1, 60)), 3)
        index = P.SuffixArray(symbols)
        assert index.suffixes.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())
        values = rng.permutation(len(symbols))
        matrix = P.WaveletMatrix(values, len(values))
        low = rng.integers(0, len(values), 20)
        high = low + rng.integers(1, len(values) - low + 1)
        than = rng.integers(0, len(values) + 1, 20)
        inside = [np.sort(values[a:b]) for a, b in zip(low, high, strict=True)]
        assert matrix.smaller(low, high, than).tolist() == [int((v < t).sum()) for v, t in zip(inside, than, strict=True)]
        ranks = np.array([rng.integers(0, len(v)) for v in inside])
        assert matrix.ranked(low, high, ranks).tolist() == [int(v[r]) for v, r in zip(inside, ranks, strict=True)]


def test_query_equals_the_definition(workers, make_docs, tmp_path, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{w}" for w in words_with_runs(rng, rng.randrange(0, 200), rng.choice([2, 5, 80])))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \t\n\x0b\x0c\r "), (None, "a " * 40), (503, " x y " * 30), (504, "é\x00b " * 13),
             (505, "one two three " * 20_000), (505, rows[3][1]), (3, rows[3][1])]
    make_docs(rows, "1 AS runs").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op13_periodic_runs(workers, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
                            ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    got = sorted((str(r[0]), *map(str, r[1:])) for r in found.collect())
    short = [r for r in rows if r[1] is None or len(r[1]) < 100_000]
    want = [(d, *plain(d, t)) for d, t in short]
    words, h = 60_000, zlib.crc32(b"505")
    assert h % 10  # the long text stays as it is: one run of all its words
    want.append((505, 1, 0, words, 3, 1000 * words // 3, hashlib.sha256(b"0,60000,3\n").hexdigest(), hashlib.sha256(b"one two three").hexdigest()))
    assert got == sorted((str(r[0]), *map(str, r[1:])) for r in want)
    assert sum(1 for d, _ in rows if zlib.crc32(str(d).encode()) % 10 == 0) > 5


def test_columns_stay_and_clashing_names_are_replaced(workers, make_docs):
    docs = make_docs([(1, "a b " * 10)], "5 AS period").selectExpr("*", "doc_id AS other", "'k' AS group")
    row = P.periodic_runs(docs).first()
    assert row["other"] == 1 and row["group"] == "k" and row["period"] == 2 and row["collapsed"] == "a b" and row["text"] == "a b " * 10
    assert [tuple(r) for r in row["runs"]] == [(0, 20, 2)]
    assert P.periodic_runs(docs.limit(0)).collect() == []
