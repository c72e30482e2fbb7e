import random

import numpy as np
import pytest

from tickframe.llm import cross_parsing as C

WORDS = {"aa": ["lorem", "dolor", "amet", "sit"], "bb": ["kiwi", "zebra", "yoga", "quiz"], "cc": ["fjord", "blåbær", "skjønn"]}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(make_docs):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 4)]
    return C.fit(make_docs([*rows, (50, None, "aa"), (51, "123 !", "bb"), (52, "lorem", None)]))


def plain_phrases(sample: str, text: str) -> int:
    """Phrases by definition: the longest prefix of the rest that occurs in the sample, one character at least."""
    at, count = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


def test_automaton_has_all_substrings_and_no_others():
    rng = np.random.default_rng(3)
    for _ in range(20):
        text = rng.integers(0, 3, 30).astype(np.uint8)
        step = C._moves(text)
        whole = bytes(text.tolist())
        for _ in range(60):
            probe = bytes(rng.integers(0, 3, rng.integers(1, 8)).tolist())
            state = 0
            for c in probe:
                state = step[state].get(c, -1) if state >= 0 else -1
            assert (state >= 0) == (probe in whole)


@pytest.mark.parametrize("block", [1, 3, 40, 10**9])
def test_phrases_equal_the_definition(model, monkeypatch, block):
    """Phrases are those of the whole text, whatever the blocks that it is parsed in."""
    parser, rng = C._Parser(model), random.Random(2)
    texts = [prose(rng, rng.choice("abc") * 2, rng.randint(1, 30)) for _ in range(30)]
    # stretches of the labelled text itself: phrases of many blocks, so that parses don't meet for long
    texts += [model.samples[0][1][:900], model.samples[1][1][50:700] + model.samples[0][1][10:500], "q" * 300, "a"]
    parts = [parser.symbols(t)[0] for t in texts]
    samples = [bytes(parser.symbols(t)[0].tolist()) for _, t in model.samples]
    want = [[plain_phrases(sample.decode("latin-1"), bytes(part.tolist()).decode("latin-1")) for sample in samples] for part in parts]
    monkeypatch.setattr(C, "BLOCK", min(block, max(map(len, parts))))
    assert parser.phrases(parts).tolist() == want
    monkeypatch.setattr(C, "PLACES_AT_ONCE", 10)  # one language at a time
    assert parser.phrases(parts).tolist() == want


def test_languages_and_odd_rows(model, make_docs):
    rng = random.Random(4)
    rows = [(i, prose(rng, lang, 12), None) for i, lang in enumerate(["aa", "bb", "cc"])]
    rows += [(10, None), (11, ""), (12, "12 #"), (13, "日本語"), (14, prose(rng, "bb", 60_000)), (14, "lorem dolor"), (None, "kiwi zebra yoga")]
    found = {(r["doc_id"], (r["text"] or "")[:5]): r for r in
             C.identify(make_docs(rows, "'x' AS lang_PRED"), model).collect()}
    assert [found[i, rows[i][1][:5]]["lang_pred"] for i in range(3)] == ["aa", "bb", "cc"]
    assert [found[i, t]["lang_pred"] for i, t in ((10, ""), (11, ""), (12, "12 #"))] == ["und"] * 3
    assert found[13, "日本語"]["lang_pred"] == "aa"  # equal numbers of phrases: the first language
    long = next(r for (i, _), r in found.items() if i == 14 and len(r["text"]) > 100)
    assert long["lang_pred"] == "bb" and found[None, "kiwi "]["lang_pred"] == "bb"
    assert all(0 <= r["score"] <= 1 for r in found.values()) and len(found) == len(rows)


def test_no_labelled_text_and_no_rows(make_docs):
    empty = C.fit(make_docs([(1, "lorem", None)]))
    assert [tuple(r) for r in C.identify(make_docs([(1, "lorem")]), empty).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert C.identify(make_docs([]), empty).count() == 0
    one = C.fit(make_docs([(1, "lorem ipsum", "la")]))
    assert C.predict(one, ["lorem"]) == [("la", 1.0)]


def test_language_limit_is_an_error(make_docs):
    with pytest.raises(ValueError):
        C.fit(make_docs([(1, "a", "x"), (2, "b", "y")]), max_languages=1)


def test_large_scripts_keep_their_letters(make_docs, monkeypatch):
    """Languages of hundreds of letters each, two of them with the same letters, are told apart by the letters themselves."""
    rng = random.Random(6)
    han, hangul = [chr(0x4E00 + 7 * i) for i in range(2000)], [chr(0xAC00 + 5 * i) for i in range(2000)]
    words = {name: ["".join(rng.choices(letters, k=3)) for _ in range(900)] for name, letters in
             (("l1", "abcdefghijklmnopqrstuvwxyz"), ("l2", han), ("l3", han), ("l4", hangul))}
    rows = [(10 * k + i, " ".join(rng.choices(words[lang], k=600)), lang) for k, lang in enumerate(words) for i in range(5)]
    large = C.fit(make_docs(rows))
    own = {lang: [" ".join(rng.choices(words[lang], k=12)) for _ in range(20)] for lang in words}
    for lang, texts in own.items():
        assert [name for name, _ in C.predict(large, texts)] == [lang] * 20
    # the labelled text of the first language alone or beside the large scripts: its phrases stay the same
    alone = C._Parser(C.LanguageModel(large.samples[:1]))
    parser = C._Parser(large)
    assert alone.phrases([alone.symbols(own["l1"][0])[0]])[0, 0] == parser.phrases([parser.symbols(own["l1"][0])[0]])[0, 0]
    monkeypatch.setattr(C, "BLOCK", 10**6)
    for texts in own.values():
        text = texts[0] + " 한국 unknown"
        want = [plain_phrases(sample.replace("\n", " "), text) for _, sample in large.samples]
        assert parser.phrases([parser.symbols(text)[0]])[0].tolist() == want


def test_hash_table_finds_all_keys_and_no_others():
    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 3000):
        numbers = rng.permutation(3 * n + 3).astype(np.uint64) * np.uint64(977)
        table = C._HashTable(numbers[:n], np.arange(n, dtype=np.uint32))
        values, missing = table.find(numbers)
        assert values[:n].tolist() == list(range(n)) and missing.tolist() == list(range(n, len(numbers)))


def test_the_sample_is_bounded_before_the_driver(make_docs, collected):
    rng = random.Random(9)
    rows = [(1, "12 " * 9000 + prose(rng, "aa", 20_000), "aa")]  # no other text of this language, letters far behind
    rows += [(10 + i, prose(rng, "bb", 700), "bb") for i in range(30)]
    rows += [(100, "kort", "cc"), (101, prose(rng, "cc", 20_000), "cc")]
    found = C.fit(make_docs(rows), chars_per_language=5000)
    assert found.languages == ["aa", "bb", "cc"]
    assert sum(collected) == 15_000 and all(len(t.replace("\n", "")) <= 5000 for _, t in found.samples)
    assert found.samples[0][1] in rows[0][1] and found.samples[0][1][0].isalpha()
    assert [lang for lang, _ in C.predict(found, [prose(rng, lang, 10) for lang in ("aa", "bb", "cc")])] == ["aa", "bb", "cc"]
