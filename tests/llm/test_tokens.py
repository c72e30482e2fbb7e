import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickframe.llm import cutting_stock as K
from tickframe.llm import token_files as F
from tickframe.llm._common import scratch_path
from tickframe.llm._tokens import Encoder, default_tokenizer

ODD = ["a", "b", "'s", " ", "  ", "\n", " \n", "\t", ".", ",", "é", "12", "日本", "\xa0", "　", "<|endoftext|>", "'", "\x1c", "\r\n", "don't", " '"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(default_tokenizer())  # with the library's own defaults
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def documents():
    rng = random.Random(7)
    rows = [(i * 31 % 503, "".join(rng.choice(ODD) for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(600 + i, " ".join(rng.choice(["token", "file", "of", "words."]) for _ in range(rng.randrange(1, 1500)))) for i in range(60)]
    return rows + [(900, None), (901, ""), (902, " ".join(f"w{i}" for i in range(9000)))]


def test_stretches_have_the_ids_of_whole_texts(library):
    rng, encoder = random.Random(3), Encoder(default_tokenizer())
    for _ in range(3000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(10)))
        assert np.frombuffer(encoder.encode([text])[0], dtype=encoder.dtype).tolist() == library(text), repr(text)


def test_marks_behind_a_word_are_encoded_once(library):
    rng, encoder = random.Random(5), Encoder(default_tokenizer())
    tails = ["&&&", "%%%", ",***", "!!", "$$$", "###", ".", ",", '."', "'s", "'", ".'s", "|", "`~", "=9", "\n&&", "…", "²"]
    words = ["Wort", "é", "ab", "größ", "x1", "日本", "ße", "a", "1", "µ", "Ωm", "it's"]
    for _ in range(300):
        text = " ".join(rng.choice(words) + rng.choice(["", *tails]) for _ in range(8))
        assert np.frombuffer(encoder.encode([text])[0], dtype=encoder.dtype).tolist() == library(text), repr(text)
    seen = []
    encoder = Encoder(default_tokenizer())
    plain = encoder._learned
    encoder._learned = lambda words, lead: seen.extend(words) or plain(words, lead)
    encoder.encode(["the wort&&& wort%%% wort,*** wort wort."])
    assert sorted(seen) == ["the", "wort"]


def test_special_tokens_in_a_text_are_the_librarys(library):
    encoder = Encoder(default_tokenizer())
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|endoftext|> ", "plain <|endoftext"):
        assert np.frombuffer(encoder.encode([text, "a b"])[0], dtype=encoder.dtype).tolist() == library(text), text
    assert 50256 in library("a <|endoftext|> b")


def test_forgetting_stretches_keeps_results(library, monkeypatch):
    monkeypatch.setattr("tickframe.llm._tokens.KEPT_STRETCHES", 4)
    encoder = Encoder(default_tokenizer())
    for text in ("one two three four five six, seven.", "two nine ten, one", "three eleven"):
        assert np.frombuffer(encoder.encode([text])[0], dtype=encoder.dtype).tolist() == library(text)


def test_token_files_round_trip(make_docs, library, workers):
    rows = [*documents(), (901, "twin id"), (None, "no id"), (902, "z")]
    path = scratch_path(workers, "tokens")
    manifest = F.write_tokens(make_docs(rows, "1 AS shard").repartition(5), path).orderBy("shard").collect()
    found = F.read_documents(workers, path).collect()
    assert len(found) == len(rows) == sum(m["n_docs"] for m in manifest)
    at = 0
    for m in manifest:
        assert m["base"] == at
        at += m["n_tokens"]
    want = sorted(((d is not None, d or 0), np.array([*library(t), 2], dtype="<u4").tobytes()) for d, t in rows)
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), bytes(r["tokens"])) for r in found) == want
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):  # gapless, ids ascending with null first
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["tokens"])
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_token_files_of_an_empty_table(make_docs, workers):
    path = scratch_path(workers, "tokens")
    F.write_tokens(make_docs([]), path)
    assert F.read_documents(workers, path).count() == 0


def test_packing(make_docs, library):
    rows = [*documents(), (None, "no id"), (5000, "x" * 30_000), (901, "twin id")]
    found = K.pack(make_docs(rows, "1 AS start").repartition(4)).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048
    for d, text in rows:
        ids = np.array([*library(text), 1], dtype="<u4")
        if d != 901:  # two documents have this id
            own = sorted(by_doc[d], key=lambda r: r["start"])
            assert [r["start"] for r in own] == list(range(0, len(ids), 2048))
            assert all(r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in own)
            assert sum(r["length"] for r in own) == len(ids)
    assert len(by_doc[901]) == 2
    total = sum(r["length"] for r in found)
    assert len(by_sequence) * 2048 < 1.06 * total + 2048


def test_packing_an_empty_table(make_docs):
    assert K.pack(make_docs([])).count() == 0


def test_plans_meet_the_demand_with_little_waste():
    rng = np.random.default_rng(1)
    for n in (1, 7, 400, 50_000):
        sizes = np.minimum(63, rng.lognormal(2.3, 0.9, n).astype(int) + 1)
        demand = np.bincount(sizes, minlength=65)[1:]
        plan = K.plan(demand, 64)
        assert (sum(p * t for p, t in plan) == demand).all()
        assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in plan)
        assert sum(t for _, t in plan) <= np.ceil(sizes.sum() / 64) * 1.03 + 2


def test_pricing_is_an_unbounded_knapsack():
    rng = np.random.default_rng(2)
    for _ in range(20):
        values, best = rng.random(9) * (rng.random(9) < 0.7), np.zeros(21)
        for room in range(1, 21):
            best[room] = max([best[room - 1], *(values[k] + best[room - k - 1] for k in range(min(9, room)))])
        value, pattern = K.price(values, 20)
        assert np.isclose(value, best[20]) and np.isclose(pattern @ values, value) and pattern @ np.arange(1, 10) <= 20
