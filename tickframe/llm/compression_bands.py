"""Quality rules by compression bands.

How far zstandard shrinks a text tells repetition (it shrinks too much) and noise
(it shrinks too little) from prose.  Short texts shrink less than long ones, so
each size has its own band of accepted ratios (bytes over compressed bytes).  The
whole text must lie in the band of its size; besides, the text is cut into chunks
of a fixed number of bytes, and chunks outside their band may make up a small
share of it at most.  The base rules come first: too few words, or too many words
in repeated runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickframe.llm._common import WHITE_SPACE, appending, byte_texts

LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.25
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
RUN_WORDS = 5
#: Bytes from which a band holds, and its smallest and largest accepted ratio.
BANDS = ((0, 0.0, 2.4), (256, 1.05, 2.4), (512, 1.15, 2.5), (1024, 1.25, 2.6), (2048, 1.35, 2.7), (4096, 1.4, 2.8),
         (8192, 1.45, 2.9), (16384, 1.5, 3.1), (65536, 1.5, 3.5), (1 << 20, 1.5, 4.0))

SYMBOLS = b"#*$%&|<>"
FIELDS = [
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("base_failed", T.BooleanType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("bad_chunk_share", T.DoubleType()), T.StructField("kept", T.BooleanType()),
]
_CONTINUED = bytes(range(0x80, 0xC0))
_STARTS = np.array([b for b, _, _ in BANDS])
_LOW, _HIGH = np.array([low for _, low, _ in BANDS]), np.array([high for _, _, high in BANDS])
_WORD = re.compile(rb"[^" + WHITE_SPACE + rb"]")


def repeated_run_words(words: list[bytes], run: int = RUN_WORDS) -> int:
    """Words in runs of ``run`` words that the text has twice or more, the first occurrence included."""
    n = len(words) - run + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    code, have = ids, 1
    while have < run:  # runs of twice the words, then of what is missing: numbers of pairs of numbers
        step = min(have, run - have)
        code = code[:len(ids) - have - step + 1] * len(ids) + code[step:][:len(ids) - have - step + 1]
        code = np.unique(code, return_inverse=True)[1]
        have += step
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + run] -= 1
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, count = set(), 0
    if b"\n" not in text:
        return 0
    for line in text.split(b"\n"):
        if line in seen:
            count += 1
        elif _WORD.search(line):
            seen.add(line)
    return count


def in_band(size: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Whether texts of ``size`` bytes may shrink by ``ratio``."""
    band = np.searchsorted(_STARTS, size, side="right") - 1
    return (ratio >= _LOW[band]) & (ratio <= _HIGH[band])


def compression(text: bytes, packer: zstandard.ZstdCompressor, chunk_bytes: int = CHUNK_BYTES) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of bytes in chunks outside their band, and whether the text passes."""
    if not text:
        return 1.0, 0.0, True
    ratio = len(text) / len(packer.compress(text))
    if len(text) <= chunk_bytes:
        ok = bool(in_band(np.array([len(text)]), np.array([ratio]))[0])
        return ratio, 0.0 if ok else 1.0, ok
    view = memoryview(text)
    size = np.diff([*range(0, len(text), chunk_bytes), len(text)])
    packed = np.array([len(packer.compress(view[i:i + chunk_bytes])) for i in range(0, len(text), chunk_bytes)])
    bad = float(size[~in_band(size, size / packed)].sum() / len(text))
    return ratio, bad, bool(in_band(np.array([len(text)]), np.array([ratio]))[0]) and bad <= MAX_BAD_CHUNKS


def judge(text: bytes, packer: zstandard.ZstdCompressor) -> tuple:
    """The values of ``FIELDS`` for a text in UTF-8."""
    words = text.split()
    bare = text.translate(None, WHITE_SPACE)
    repeated = repeated_run_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * len(words)
    ratio, bad, ok = compression(text, packer)
    return (len(words), len(bare.translate(None, _CONTINUED)), len(bare) - len(bare.translate(None, SYMBOLS)), duplicate_lines(text), repeated, failed, ratio, bad, ok and not failed)


def rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, base_failed, ratio, bad_chunk_share and kept behind its columns.

    A null text is the empty one: no words, so it fails the base rules.  One row per input row.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        kinds = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}
        for batch in batches:
            found = [judge(t, packer) for t in byte_texts(batch.column(text))]
            columns = zip(*found, strict=True) if found else [[] for _ in FIELDS]
            yield batch, [pa.array(c, kinds[f.dataType]) for c, f in zip(columns, FIELDS, strict=True)]

    return appending(docs, FIELDS, compute)
