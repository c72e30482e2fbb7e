"""Language identification by cross-parsing entropy.

One suffix automaton per language is built over labelled text.  A text is cut
into phrases, each the longest string from the current place that occurs
anywhere in the language's labelled text; the fewer phrases a character needs,
the closer the language.  The language with the smallest normalised number of
phrases wins.

Every letter of the labelled text has a symbol of its own, so the transitions of
all automata are kept sparse, in one cuckoo hash table.  Where a phrase ends, the
parse goes on in the state behind the next phrase's first character.  A text then
costs two table look-ups per character and language, done for many texts at
once with numpy.  A long text is parsed in blocks of ``BLOCK`` characters side by
side, each as if a phrase began there; then each block is parsed again from the
state in which the block before it ended, up to the first place where both
parses begin a phrase, from which on they are the same.  So the number of
phrases is that of the whole text, whatever the block.

The labelled text is a bounded sample (``chars_per_language`` characters of each
language, of documents chosen by a hash of their id; the last is cut at the
bound), cut by Spark before it reaches the driver; every document is scored on
its whole text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm._common import appending, kept_by_worker, runs_of, starts_of, written

UNDETERMINED = "und"
CHARS_PER_LANGUAGE = 20_000
DOCS_PER_LANGUAGE = 60
MAX_LANGUAGES = 250
BLOCK = 4096
BATCH_CHARS = 2_000_000
PLACES_AT_ONCE = 8_000_000

_NO_KEY = np.uint64(2**64 - 1)
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def _moves(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions by state of the automaton of all substrings of ``symbols``; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in symbols.tolist():
        new = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            target = step[at][c]
            if longest[at] + 1 == longest[target]:
                link[new] = target
            else:
                copy = len(step)
                step.append(dict(step[target]))
                link.append(link[target])
                longest.append(longest[at] + 1)
                link[target] = link[new] = copy
                while at >= 0 and step[at].get(c) == target:
                    step[at][c] = copy
                    at = link[at]
        last = new
    return step


class _HashTable:
    """Values (uint32) of distinct keys (uint64).  Each key is in one of two places; there are 2.5 to 5 places for each key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        rng, bits = np.random.default_rng(5), max(4, (5 * len(keys) // 2).bit_length())
        while (held := self._held(keys, bits, rng.integers(0, 2**63, 2, dtype=np.uint64) | np.uint64(1))) is None:
            bits += 1
        full = held >= 0
        self.keys, self.values = np.full(len(held), _NO_KEY), np.zeros(len(held), dtype=np.uint32)
        self.keys[full], self.values[full] = keys[held[full]], values[held[full]]

    def _held(self, keys: np.ndarray, bits: int, factors: np.ndarray) -> np.ndarray | None:
        """The number of the key in each place (-1: none); no result if some keys find no place."""
        self.shift, self.factors = np.uint64(64 - bits), factors
        places = np.array([self._places(keys, f) for f in factors], dtype=np.int64)
        held, side, hand = np.full(1 << bits, -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        for _ in range(200):
            if not len(hand):
                return held
            at = places[side[hand], hand]
            before = held[at]
            held[at] = hand
            # keys that were driven out or did not get their place try the other one
            hand = np.concatenate([hand[held[at] != hand], np.unique(before[before >= 0])])
            side[hand] ^= 1
        return None

    def _places(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return (keys * factor >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key (any number where there is none), and the indices of the keys that are not there."""
        at = self._places(keys, self.factors[0])
        rest = np.flatnonzero(self.keys[at] != keys)
        keys = keys[rest]
        at[rest] = other = self._places(keys, self.factors[1])
        return self.values[at], rest[self.keys[other] != keys]


@dataclass(frozen=True)
class LanguageModel:
    """Labelled text of each language, in alphabetical order of the languages."""

    samples: tuple[tuple[str, str], ...]

    @property
    def languages(self) -> list[str]:
        return [name for name, _ in self.samples]


class _Parser:
    """The automata of a model as one hash table of transitions.  Keys: state * ``size`` + symbol; states count through."""

    def __init__(self, model: LanguageModel) -> None:
        letters = _letters()
        points = np.concatenate([_points(text) for _, text in model.samples])
        found = np.unique(points[letters[points]])
        self.size = len(found) + 2
        # 0: not a letter, 1: a letter that no labelled text has
        self.symbol = letters.astype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.symbol[found] = np.arange(2, self.size)
        keys, values, begin, base = [], [], [], 0
        self.restart = np.zeros((len(model.samples), self.size), dtype=np.uint32)
        for restart, (_, text) in zip(self.restart, model.samples, strict=True):
            step = _moves(self.symbols(text)[0])
            dead = base + len(step)  # where a character unknown to the language leads: the next one begins a phrase
            state = np.repeat(np.arange(len(step)), [len(moves) for moves in step])
            symbol = np.array([c for moves in step for c in moves], dtype=np.int64)
            target = np.array([to for moves in step for to in moves.values()], dtype=np.int64) + base
            restart[:] = dead
            restart[symbol[state == 0]] = target[state == 0]
            inner = state > 0  # no phrase is parsed from the root: ``restart`` has its transitions
            keys.append((state[inner] + base) * self.size + symbol[inner])
            values.append(target[inner])
            begin.append(dead)
            base = dead + 1
        self.begin = np.array(begin, dtype=np.uint32)
        self.table = _HashTable(np.concatenate(keys).astype(np.uint64), np.concatenate(values).astype(np.uint32))

    def symbols(self, text: str) -> tuple[np.ndarray, bool]:
        """Symbols of a text, runs of other characters than letters as one; whether it has a letter."""
        out = self.symbol[_points(text)]
        keep = out != 0
        has = bool(keep.any())
        keep[1:] |= out[:-1] != 0
        return out[keep], has

    def phrases(self, parts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each symbol array (rows) in each language (columns)."""
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        # so many languages at once that a byte for each of them and symbol is a bounded table
        step = max(1, PLACES_AT_ONCE // max(1, int(lengths.sum())))
        groups = [slice(i, i + step) for i in range(0, len(self.begin), step)]
        return np.concatenate([self._phrases(parts, lengths, self.begin[g], self.restart[g]) for g in groups], axis=1)

    def _phrases(self, parts: list[np.ndarray], lengths: np.ndarray, dead: np.ndarray, restart: np.ndarray) -> np.ndarray:
        text, starts = np.concatenate([*parts, np.zeros(0, self.symbol.dtype)]), starts_of(lengths)
        blocks = np.maximum(1, -(-lengths // BLOCK))
        owner = np.repeat(np.arange(len(parts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(starts_of(blocks)[:-1], blocks)
        begin = starts[:-1][owner] + nth * BLOCK
        size = np.minimum(lengths[owner] - nth * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        # places (by size) of the blocks that follow on another, and of that other
        later = np.flatnonzero(nth > 0)
        follows, before = place[later], place[later - 1]
        begin, size = begin[order], size[order]
        noted = np.full(len(order), -1, dtype=np.int64)
        noted[follows] = np.arange(len(follows))
        begun = np.zeros((len(dead), len(follows), BLOCK if len(follows) else 0), dtype=bool)
        state = np.repeat(dead[:, None], len(begin), axis=1)
        count = np.zeros(state.shape, dtype=np.int64)
        size_ = np.uint64(self.size)
        active = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        for t, n in enumerate(active.tolist()):
            symbol = text[begin[:n] + t]
            now, ends = self.table.find((state[:, :n] * size_ + symbol).ravel())
            language = ends // n
            row = ends - language * n
            now[ends] = restart[language, symbol[row]]
            count[language, row] += 1
            if len(follows):
                seen = noted[row] >= 0
                begun[language[seen], noted[row[seen]], t] = True
            state[:, :n] = now.reshape(-1, n)
        if len(follows):
            self._continued(text, begin, size, follows, before, begun, state, count, restart)
        out = np.zeros((len(parts), len(dead)), dtype=np.int64)
        np.add.at(out, owner[order], count.T)
        return out

    def _continued(self, text: np.ndarray, begin: np.ndarray, size: np.ndarray, follows: np.ndarray, before: np.ndarray,
                   begun: np.ndarray, state: np.ndarray, count: np.ndarray, restart: np.ndarray) -> None:
        """Makes ``count`` and ``state`` of the blocks ``follows`` those of parses that go on from the blocks ``before``.

        ``begun``: where the parse from the block's own begin starts a phrase.  A block whose parse meets its own ends as it
        did; one that doesn't hands a new state to its successor, which is then parsed again.
        """
        alone_count, alone_state = count.copy(), state.copy()
        heir = np.full(len(begin), -1, dtype=np.int64)
        heir[before] = np.arange(len(follows))
        language = np.repeat(np.arange(len(restart)), len(follows))
        nth = np.tile(np.arange(len(follows)), len(restart))
        size_ = np.uint64(self.size)
        while len(nth):
            block = follows[nth]
            now, own = state[language, before[nth]], np.zeros(len(nth), dtype=np.int64)
            ended = np.zeros(len(nth), dtype=bool)  # without meeting the parse from the block's begin
            open_ = np.arange(len(nth))
            for t in range(BLOCK):
                done = size[block[open_]] <= t
                ended[open_[done]] = True
                open_ = open_[~done]
                if not len(open_):
                    break
                symbol = text[begin[block[open_]] + t]
                to, ends = self.table.find(now[open_] * size_ + symbol)
                starts = open_[ends]
                to[ends] = restart[language[starts], symbol[ends]]
                now[open_] = to
                own[starts] += 1
                met = starts[begun[language[starts], nth[starts], t]]
                if len(met):
                    at = (language[met], block[met])
                    skipped = begun[language[met], nth[met], :t + 1].sum(axis=1)
                    own[met] += alone_count[at] - skipped
                    now[met] = alone_state[at]
                    keep = np.ones(len(nth), dtype=bool)
                    keep[met] = False
                    open_ = open_[keep[open_]]
            changed = now != state[language, block]
            count[language, block], state[language, block] = own, now
            language, nth = language[changed], heir[block[changed]]
            language, nth = language[nth >= 0], nth[nth >= 0]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def predict(model: LanguageModel, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text.

    Score: one minus the winner's number of phrases over the runner-up's (1 with a single language).
    Equal numbers: the alphabetically first language.  ``und`` with score 0: no letter, null text or no labelled text.
    """
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    if not model.samples:
        return out
    parser, names = kept_by_worker(("cross_parsing", hash(model)), lambda: _Parser(model)), model.languages
    for part in runs_of([len(t or "") for t in texts], BATCH_CHARS):
        known = [(i, *parser.symbols(texts[i] or "")) for i in range(part.start, part.stop)]
        known = [(i, s) for i, s, has in known if has]
        if not known:
            continue
        count = parser.phrases([s for _, s in known])
        best = count.argmin(axis=1)
        two = np.sort(count, axis=1)[:, :2]
        score = 1.0 - two[:, 0] / two[:, 1] if len(names) > 1 else np.ones(len(known))
        for (i, _), b, s in zip(known, best.tolist(), score.tolist(), strict=True):
            out[i] = (names[b], s)
    return out


def fit(labelled: DataFrame, chars_per_language: int = CHARS_PER_LANGUAGE, docs_per_language: int = DOCS_PER_LANGUAGE,
        max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Labelled text per language from columns doc_id, text and lang; nulls and texts without a letter are left out.

    The sample is bounded: of each language the ``docs_per_language`` documents with the smallest hash, and of these, in
    that order, the first ``chars_per_language`` characters together.  Longer documents come last, from their first letter
    on.  More than ``max_languages`` languages are an error.
    """
    usable = labelled.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # short enough documents first, in the order of a hash of the id; no row keeps more than the bound from here on
    long = F.length("text") > chars_per_language
    window = F.when(long, F.regexp_replace("text", r"^\P{L}+", "").substr(1, chars_per_language)).otherwise(F.col("text"))
    cut = usable.select("lang", "doc_id", long.alias("long"), F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"),
                        window.alias("text"))
    order = W.partitionBy("lang").orderBy("long", "h", "doc_id", "t")
    ranked = cut.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= docs_per_language)
    before = F.sum(F.length("text")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.length("text")
    sample = written(ranked.withColumn("room", F.lit(chars_per_language) - before).where("room > 0")
                     .select("lang", "rank", F.expr("substring(text, 1, int(room))").alias("text")), "cross-parsing-sample")
    if sample.select("lang").distinct().count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    chosen: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["rank"])):
        chosen.setdefault(row["lang"], []).append(row["text"])
    return LanguageModel(tuple((name, "\n".join(own)) for name, own in sorted(chosen.items())))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred (string) and score (double) behind its columns; see ``predict``.

    One row per input row; an input column of one of these names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            found = predict(shared.value, batch.column(text).to_pylist())
            yield batch, [pa.array([lang for lang, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

    return appending(docs, FIELDS, compute)
