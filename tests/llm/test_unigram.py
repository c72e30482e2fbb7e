import random
import zlib

import numpy as np
import pytest

from tickframe.llm import catalog
from tickframe.llm import unigram_pieces as U


def plain(vocabulary, text):
    """Best sum of log scores, by dynamic programming over a dictionary."""
    own = {p: (i, s) for i, (p, s, k) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.kinds, strict=True)) if k == "piece"}
    byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)) if k == "byte"}
    penalty = min(s for _, s in own.values()) - U.UNKNOWN_PENALTY
    text = (U.MARKER + text).replace(" ", U.MARKER) if text else ""
    longest = max(map(len, own))
    best = [(0.0, 0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - longest), end):
            piece = own.get(text[begin:end])
            if piece is None and end - begin == 1:
                piece = ([byte[b] for b in text[begin].encode()], penalty)
            if piece is not None:
                ids = piece[0] if isinstance(piece[0], list) else [piece[0]]
                candidate = best[begin][0] + piece[1]
                if best[end] is None or candidate > best[end][0] + 1e-9:
                    best[end] = (candidate, begin, best[begin][2] + ids)
    return best[-1][2]


def small_vocabulary(seed=1, across=False):
    rng = random.Random(seed)
    pieces = {U.MARKER: -4.0} | {c: -6.0 + rng.random() for c in "abcé"}
    for _ in range(60):
        body = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5)))
        pieces[rng.choice(["", U.MARKER, U.MARKER * 2]) + body] = -rng.random() * 8 - 1
    if across:
        pieces["a" + U.MARKER + "b"] = -0.5
    names = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), *pieces]
    return U.Vocabulary(tuple(names), tuple([0.0] * 257 + list(pieces.values())), ("control",) + ("byte",) * 256 + ("piece",) * len(pieces), 0)


ODD = ["a", "b", "c", "é", " ", "  ", "\n", "日", "🤖", "ab", "\x00"]


@pytest.mark.parametrize("across", [False, True])
def test_best_cut_equals_dynamic_programming(across):
    vocabulary, rng = small_vocabulary(across=across), random.Random(2)
    encoder = U.Encoder(vocabulary)
    assert encoder.cuts is not across
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(12))) for _ in range(600)]
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(raw, dtype=encoder.dtype).tolist() == plain(vocabulary, text), repr(text)
        assert encoder.decode(raw) == text


def test_public_vocabulary_and_odd_rows(make_docs):
    vocabulary = U.read_vocabulary()
    encoder = U.Encoder(vocabulary)
    rows = [(1, None), (2, ""), (3, "The token of the words, the end."), (3, " two  spaces "), (4, "日本語 🤖\n\ttab"), (None, "x"), (5, "word " * 30_000)]
    found = U.decode(U.encode(make_docs(rows, "1 AS pieces"), encoder), encoder).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["decoded"] or "") for r in found) == sorted((d or 0, t or "", t or "") for d, t in rows)
    by = {r["text"]: r for r in found}
    assert by[None]["pieces"] is None and by[None]["decoded"] is None and bytes(by[""]["pieces"]) == b""
    for text in ("The token of the words, the end.", "日本語 🤖\n\ttab"):
        assert np.frombuffer(by[text]["pieces"], dtype="<u4").tolist() == plain(vocabulary, text)
    assert U.encode(make_docs([]), encoder).count() == 0


def test_round_trips_in_one_pass(workers, make_docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "The token of the words, the end."), (3, " two  spaces "), (4, "日本語 🤖\n\ttab"), (None, "x"),
            (5, "word " * 30_000), (6, "y" * 5000), (7, "a▁b")]
    make_docs(rows, "1 AS n_pieces").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.op6_unigram_pieces(workers, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("n_pieces", "bigint"), ("ids_crc32", "bigint"), ("round_trip", "boolean")]
    encoder, want = U.Encoder(U.read_vocabulary()), []
    for d, t in rows:
        ids = np.frombuffer(encoder.encode([t or ""])[0], dtype=encoder.dtype).astype("<u4").tobytes()
        want.append((d, *((None, None) if t is None else (len(ids) // 4, zlib.crc32(ids))), d != 7))  # the marker comes back as a space
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert encoder.known.keys() and max(map(len, encoder.known)) <= U.LONGEST_KEPT


def test_double_array_has_its_keys_and_no_others():
    rng = random.Random(3)
    keys = {bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))): i for i in range(3000)}
    trie = U.DoubleArray(list(keys.items()))
    for key in [*keys, *(bytes(rng.randrange(256) for _ in range(rng.randrange(1, 5))) for _ in range(3000))]:
        state = np.zeros(1, dtype=np.int64)
        for c in key:
            state = trie.step(state, np.array([c], dtype=np.uint8)) if state[0] >= 0 else state
        value = trie.value[state[0]] if state[0] >= 0 else -1
        assert value == keys.get(key, -1)


def test_bytes_that_are_no_text_are_replaced():
    encoder = U.Encoder(small_vocabulary())
    assert encoder.decode(np.array([1 + 0xC3, 1 + 0x28], dtype=encoder.dtype).tobytes()) == "�("
