import random

import zstandard

from tickframe.llm import compression_bands as B


def plain(text):
    words = text.encode().split()
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + 5)}
    lines, seen = 0, []
    for line in text.split("\n"):
        if any(c not in " \t\r\x0b\x0c" for c in line):
            lines += line in seen
            seen.append(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), lines, len(covered)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_base_counts_equal_the_definition(make_docs):
    rng = random.Random(2)
    alphabet = ["a", "b", "é", "日", "#", "a b c d e", "\n", "same line\n", " ", "\x0b", "|x|", "　"]
    rows = [(i, " ".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "w " * 9), (503, " ".join(map(str, range(10)))), (503, "x")]
    found = B.rules(make_docs(rows, "1 AS KEPT")).collect()
    got = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in found)
    want = []
    for d, t in rows:
        counts = plain(t or "")
        want.append((d, *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]))
    assert got == sorted(want)
    assert not any(r["kept"] for r in found if r["base_failed"])


def test_bands_tell_prose_from_repetition_and_noise():
    packer = zstandard.ZstdCompressor(level=B.LEVEL)
    verdict = lambda t: B.judge(t.encode(), packer)[-1]
    for n in (12, 60, 200, 800, 3000, 12_000):
        assert verdict(prose(n, n)), n
    rng = random.Random(8)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(30)) for _ in range(200))
    near = " ".join(f"item {i} of the list is in stock" for i in range(400))  # no window repeats, yet it shrinks
    assert not verdict(noise) and not verdict(near)
    # noise in most of a long text shows in its chunks though the whole is in its band
    mixed = noise * 1 + " " + prose(3, 900)
    assert B.compression(mixed.encode(), packer)[1] > 0


def test_chunks_cover_the_whole_text():
    packer = zstandard.ZstdCompressor(level=B.LEVEL)
    text = (prose(1, 4000) + " " + "ab " * 8000).encode()
    size = len(text)
    parts = [text[i:i + B.CHUNK_BYTES] for i in range(0, size, B.CHUNK_BYTES)]
    bad = sum(len(p) for p in parts if not B.in_band(B.np.array([len(p)]), B.np.array([len(p) / len(packer.compress(p))]))[0])
    assert B.compression(text, packer)[1] == bad / size
    assert not B.compression(text, packer)[2]


def test_empty_table(make_docs):
    assert B.rules(make_docs([])).count() == 0
