import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tickframe.llm import bloom_variants as B
from tickframe.llm import catalog


def plain_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                found[run] += 1
    return found


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts):
    """(form, root, n, n_near, form_n) by word, all pairs compared."""
    near = {w: [v for v in counts if v != w and is_near(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "Éclair", "éclair"]
    rows = []
    for i in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(base)
            if rng.random() < 0.4:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("abcdeÿ") + w[p + 1:], w[:p] + rng.choice("abc") + w[p:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1"]).join(words)))
    rows += [(200 + i, "frequentword " * 300) for i in range(50)]  # a word that a third of all words are
    rows += [(260, "cabcabcab " * 4 + "cabcabcabd " * 9 + "cabcabcabde " * 19)]  # forms of forms
    long = "x" * 3000
    rows += [(300, f"{long} {long} {long} {long[:-1]}y {long[:-1]}y {long[:-1]}y {long}z {long}z {long}z"), (301, None), (302, ""), (None, "frequentword frequentward")]
    return rows + [(300, "frequentward frequentward frequentward"), (7, rows[7][1])]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def found_in(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_counts(make_docs, rows, monkeypatch):
    docs = make_docs(rows, "1 AS word").repartition(3)
    want = dict(plain_counts(rows))
    assert {r["word"]: r["n"] for r in B.counted_words(docs).collect()} == want
    monkeypatch.setattr(B, "KEPT_WORDS", 3)
    assert {r["word"]: r["n"] for r in B.counted_words(docs).collect()} == want


def test_query_equals_all_pairs(workers, make_docs, rows, tmp_path):
    make_docs(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op11_bloom_variants(workers, str(tmp_path))
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    counts = {w: n for w, n in plain_counts(rows).items() if n >= 3}
    want = plain(counts)
    assert found_in(found) == want
    assert len(want) > 200 and max(n for _, _, _, n, _ in want.values()) >= 5
    assert any(form and root not in (form, w) for w, (form, root, *_) in want.items())  # chains


def test_passes_of_a_bounded_filter_lose_nothing(workers, rows, monkeypatch):
    counts = {w: n for w, n in plain_counts(rows).items() if n >= 3}
    vocabulary = workers.createDataFrame(list(counts.items()), "word string, n bigint")
    monkeypatch.setattr(B, "FILTER_BYTES", 3 * 64)
    monkeypatch.setattr(B, "CHUNK_BLOCKS", 2)
    monkeypatch.setattr(B, "PROBES_AT_ONCE", 1000)
    assert found_in(B.variants(vocabulary)) == plain(counts)


def test_a_chain_of_forms(workers):
    """Each word is the form of the one before; ties go to the smaller word; half the count is enough, less is not."""
    words = [("abcde", 3), ("abcdef", 6), ("abcdefg", 12), ("abcdefgh", 24), ("abcdefghi", 48), ("abcdefghij", 95)]
    words += [("zzzza", 4), ("zzzzb", 9), ("zzzzc", 9)]
    found = found_in(B.variants(workers.createDataFrame(words, "word string, n bigint")))
    assert found == plain(dict(words))
    assert found["abcde"][:2] == ("abcdef", "abcdefghi") and found["abcdefghi"][0] is None and found["zzzza"][0] == "zzzzb"


def test_no_words(workers, make_docs, tmp_path):
    assert B.variants(workers.createDataFrame([], "word string, n bigint")).collect() == []
    make_docs([(1, None), (2, "a b c"), (3, "")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.op11_bloom_variants(workers, str(tmp_path)).collect() == []


def test_filters_hold_all_their_words():
    rng = np.random.default_rng(1)
    words = ["".join(map(chr, rng.integers(97, 123, 7))) for _ in range(2000)]
    x = B.mixed((B.letters_of(words) * B.powers(7)).sum(axis=1, dtype=np.uint64))
    shards = {7: (0, 63, 2000)}
    lanes = np.zeros((63, 8), dtype=np.uint64)
    for lane in range(8):
        np.bitwise_or.at(lanes, (B.Filters.places(shards, 7, x), lane), np.uint64(1) << B.bits_of(x, lane))
    held = B.Filters(shards, 0, lanes)
    own = (B.letters_of(words) * B.powers(7)).sum(axis=1, dtype=np.uint64)
    assert len(held.held(7, own)) == 2000
    others = B.letters_of(["".join(map(chr, rng.integers(65, 91, 7))) for _ in range(20000)])
    assert len(held.held(7, (others * B.powers(7)).sum(axis=1, dtype=np.uint64))) < 100  # 0.06 % expected
