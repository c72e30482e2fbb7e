import random

import numpy as np
import xxhash

from tickframe.llm import simhash_pivots as S
from tickframe.llm.components import components


def plain_fingerprint(text: str) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    """Smallest doc_id within links of at most 4 bits, by comparing all pairs."""
    prints = [plain_fingerprint(t or "") for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return prints, [least.get(find(i)) for i in range(len(rows))]


def near_copies():
    rng = random.Random(5)
    rows = []
    for group in range(12):
        words = [rng.choice("alpha beta gamma delta omega sigma kappa".split()) + str(rng.randrange(50)) for _ in range(300)]
        for _ in range(rng.randrange(1, 14)):
            copy = words[:]
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(300)] = "x" + str(rng.randrange(9))
            rows.append((len(rows) * 7 % 997, " ".join(copy)))
    return rows


def test_classes_equal_all_pairs(make_docs):
    rows = near_copies()
    rows += [(2000, None), (2001, ""), (1999, " \t"), (2002, "One two"), (2003, "one TWO"), (2004, "É b"), (2005, "é b"),
             (2006, "long " * 50_000), rows[0], (None, rows[3][1]), (None, "only without an id")]
    prints, want = plain_classes(rows)
    assert len({*want}) < len(rows) - 10
    found = S.near_duplicates(make_docs(rows, "1 AS fp")).collect()
    key = lambda d, f, c: (d is None, d or 0, f, c is None, c or 0)
    assert sorted(key(r["doc_id"], r["fp"] & 2**64 - 1, r["component_id"]) for r in found) == sorted(
        key(d, f, c) for (d, _), f, c in zip(rows, prints, want, strict=True))


def test_a_doc_id_on_different_texts_joins_no_components(make_docs):
    rng = random.Random(13)
    a, b = (" ".join(f"{name}{rng.randrange(10**6)}" for _ in range(80)) for name in "ab")
    found = S.near_duplicates(make_docs([(1, a), (5, a), (5, b), (5, b), (None, b)])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in found) == [("1", 1), ("5", 1), ("5", 5), ("5", 5), ("None", 5)]


def test_one_of_each_class_stays(make_docs):
    rows = near_copies() + [(3000, "no other"), (3000, "no other"), (None, "without an id"), (None, "without an id"), (None, None)]
    _, want = plain_classes(rows)
    kept = S.one_of_each(make_docs(rows, "1 AS fp"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted({c for c in want if c is not None})
    assert got.count(None) == 2


def test_large_groups_are_split_without_losing_links(make_docs, monkeypatch, workers):
    monkeypatch.setattr(S, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**62)
    fps = {int(base)}
    for _ in range(300):  # a chain of near fingerprints, all in one group of each untouched key
        fps.add(int(rng.choice(list(fps))) ^ int(sum(1 << int(b) for b in rng.integers(0, 12, 2))))
    nodes = workers.createDataFrame(list(enumerate(sorted(fps))), "node bigint, fp bigint")
    found = components(S.links(nodes, 4))
    assert {r["component"] for r in found.collect()} == {0} and found.count() == len(fps)


def test_references_resolve_blocks_and_bound_distances():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 500, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in a]
    b = a ^ np.array(flips, dtype=np.uint64)
    references = S.spread_references()
    apart = np.abs(S.distance_table(a, references) - S.distance_table(b, references)).max(axis=1)
    assert (apart <= np.bitwise_count(a ^ b)).all()
    for blocks, kept in ((6, 2), (7, 3), (8, 4)):
        same = S.block_codes(a, blocks) == S.block_codes(b, blocks)
        masks = np.array([S._mask(blocks, i) for i in range(blocks)], dtype=np.uint64)
        assert (same == ((a[:, None] ^ b[:, None]) & masks == 0)).all()
        assert (same.sum(axis=1) >= kept).all()
    assert S.plan_blocks(10**3, 4) == (6, 2) and S.plan_blocks(10**10, 4) == (8, 4)


def test_empty_table_and_components(make_docs, workers):
    assert S.near_duplicates(make_docs([])).count() == 0
    links = workers.createDataFrame([(5, 4), (4, 3), (3, 9), (9, 9), (20, 21), (21, 20), (30, 30), (None, 3)], "a bigint, b bigint")
    assert sorted(map(tuple, components(links).collect())) == [(3, 3), (4, 3), (5, 3), (9, 3), (20, 20), (21, 20)]


def test_one_doc_id_on_unrelated_texts_joins_no_classes(make_docs):
    rng = random.Random(12)
    a, b, c = (" ".join(f"{name}{rng.randrange(10**6)}" for _ in range(80)) for name in "abc")
    rows = [(1, a), (2, b), (5, a), (5, b), (5, c), (5, c), (7, c), (None, a)]
    kept = S.one_of_each(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, a), (2, b), (5, c)])
