"""Toxicity: a convolutional text classifier over hashed word embeddings, trained with numpy.

A word's embedding is the sum of the rows that its hashed features (the word,
its beginnings, its end) have in one table.  Filters of several widths run over
the words of the whole text; each filter's maximum feeds a logistic output.  A
text's score is the probability shifted by the threshold of its language, so
that 0.5 is the calibrated threshold for every language.

The language that picks the threshold is guessed from the text by bucket counts
of the same features.  Labels, lang, source and doc_id are never inputs of a
score; lang is used in training only.

The classifier is fitted on the whole texts of all labelled documents.  They are
encoded once, as mini-batches in shards of some ``DOCS_PER_SHARD`` documents.
Bucket counts come from all of them.  The network starts on the driver, from
these counts and a bounded, balanced sample; then each pass trains it on every
shard from the same parameters, and Spark averages what the shards found.  The
thresholds come from every fourth document, chosen by a hash of the id, which
the network never saw.

Convolution is linear, so a word's contribution to each filter and offset is
computed once per distinct word and then gathered.
"""

from __future__ import annotations

import functools
import itertools
import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.llm._common import appending, kept_by_worker, runs_of, starts_of, written

BUCKETS = 1 << 15
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (3, 4, 5)
SUFFIX = 3
DOCS_PER_CLASS = 1500
MAX_WORDS_FITTED = 3_000_000
MAX_CHARS_A_TEXT = 360_000
EPOCHS = 8
PASSES = 2
BATCH_DOCS = 64
DOCS_PER_SHARD = 4000
ID_SLOTS = 1 << 26
#: Labels are taken for this much less certain in training, so that scores keep apart texts that are told easily.
SMOOTHING = 0.02
#: Languages told apart; of more, the less frequent count together under the name below.
MAX_LANGUAGES = 64
OTHER_LANGUAGES = "(other)"
#: Parameters are averaged as integers of the first unit, so that their order doesn't matter; logits are counted in the second.
PARAMETER_UNIT = 2.0**-24
LOGIT_UNIT = 2.0**-9
MAX_LOGIT = 40.0
CACHED_WORDS = 120_000
KEPT_PARTS = 50_000
BATCH_WORDS = 80_000
PLACES_AT_ONCE = 12_000

FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_FEATURES = 2 + len(PREFIXES)
_COLUMNS = sum(WIDTHS) * FILTERS
_OUTPUTS = len(WIDTHS) * FILTERS
_BATCHES = "shard int, held boolean, labels binary, langs array<string>, sizes binary, vocabulary binary, words binary"


def _core(word: str) -> str:
    """A word in lower case, without what is no letter or digit at its edges."""
    word = word.lower()
    return word if word.isalnum() else _EDGES.sub("", word)


class _Parts(dict):
    """Buckets of words' beginnings or ends, which many words share: ``mark`` and the part; 0 if shorter than ``least``."""

    def __init__(self, mark: str, least: int) -> None:
        super().__init__()
        self.mark, self.least = mark, least

    def __missing__(self, part: str) -> int:
        if len(self) >= KEPT_PARTS:
            self.clear()
        found = zlib.crc32(f"{self.mark}{part}".encode("utf-8", "surrogatepass")) % (BUCKETS - 1) + 1 if len(part) >= self.least else 0
        self[part] = found
        return found


_BEGINNINGS = {n: _Parts(f"{n}<", n) for n in PREFIXES}
_ENDS = _Parts(">", 1)
_WHOLE = zlib.crc32(b"=")


def _features_of(cores: list[str]) -> np.ndarray:
    """Buckets (words x features) of words' cores; bucket 0 is empty (always a zero row)."""
    out = np.zeros((len(cores), _FEATURES), dtype=np.int64)
    out[:, 0] = [zlib.crc32(c.encode("utf-8", "surrogatepass"), _WHOLE) if c else -1 for c in cores]
    out[:, 0] = np.where(out[:, 0] < 0, 0, out[:, 0] % (BUCKETS - 1) + 1)
    for k, n in enumerate(PREFIXES, 1):
        out[:, k] = list(map(_BEGINNINGS[n].__getitem__, [c[:n] for c in cores]))
    out[:, -1] = list(map(_ENDS.__getitem__, [c[-SUFFIX:] for c in cores]))
    return out


def _features(word: str) -> list[int]:
    """Buckets of a white-space separated word."""
    return _features_of([_core(word)])[0].tolist()


def _row_sums(table: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Sum of the table's rows of each word's buckets."""
    total = table[buckets[:, 0]]
    for k in range(1, buckets.shape[1]):
        total += table[buckets[:, k]]
    return total


@dataclass
class ToxicityModel:
    """``table``: bucket x (contributions to filters and offsets, then log shares by language)."""

    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    intercept: float
    languages: list[str]
    thresholds: np.ndarray
    calibration: dict[str, float] = field(default_factory=dict)


class _Numbers(dict):
    """Number of each word; words of one core have the same features and so the same number."""

    def __init__(self) -> None:
        super().__init__()
        self.cores: list[str] = []  # those whose rows are still to be made
        self.count = 0

    def __missing__(self, word: str) -> int:
        core = _core(word)
        at = self.get(core)
        if at is None:
            at = self[core] = self.count
            self.count += 1
            self.cores.append(core)
        self[word] = at
        return at


class _Words:
    """Word numbers and each number's row, for a bounded number of words at a time.

    ``row_of`` gives the rows of words' buckets.
    """

    def __init__(self, row_of: Callable[[np.ndarray], np.ndarray]) -> None:
        self.row_of = row_of
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.rows = self.row_of(np.zeros((1024, _FEATURES), dtype=np.int64))

    @property
    def count(self) -> int:
        return self.number.count

    def numbers(self, texts: Sequence[str]) -> tuple[list[np.ndarray], np.ndarray]:
        if len(self.number) > CACHED_WORDS:
            self.clear()
        number = self.number
        split = [t.split() for t in texts]
        ids = [np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)) for words in split]
        if number.cores:
            first = self.count - len(number.cores)
            if self.count > len(self.rows):
                grown = np.zeros((self.count + self.count // 2, self.rows.shape[1]), dtype=self.rows.dtype)
                grown[:first] = self.rows[:first]
                self.rows = grown
            self.rows[first:self.count] = self.row_of(_features_of(number.cores))
            number.cores = []
        return ids, self.rows


def _rows_of_table(table: np.ndarray) -> _Words:
    return _Words(functools.partial(_row_sums, table))


def _spread(ids: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts behind each other, each followed by as many ``pad`` as the widest filter needs.

    Also each text's begin and end (rows of two); an empty text is one ``pad``.
    """
    gap = np.full(max(WIDTHS), pad, dtype=np.int32)
    sizes = np.array([max(1, len(x)) for x in ids])
    parts = [p for x in ids for p in (x if len(x) else gap[:1], gap)]
    begins = starts_of(sizes + len(gap))[:-1]
    return np.concatenate(parts), np.column_stack([begins, begins + sizes])


def _convolved(rows: np.ndarray) -> np.ndarray:
    """Filter outputs at each place, before bias: contributions at the offsets added up. rows: places x columns."""
    n, out, at = len(rows) - max(WIDTHS) + 1, [], 0
    for width in WIDTHS:
        total = rows[:n, at:at + FILTERS].copy()
        for offset in range(1, width):
            total += rows[offset:n + offset, at + offset * FILTERS:at + (offset + 1) * FILTERS]
        out.append(total)
        at += width * FILTERS
    return np.hstack(out)


def _pieces(bounds: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
    """(text, begin, end) of all texts in runs of ``PLACES_AT_ONCE`` places or so; a longer text comes in several pieces."""
    pieces = [(n, i, min(i + PLACES_AT_ONCE, b)) for n, (a, b) in enumerate(bounds.tolist()) for i in range(a, b, PLACES_AT_ONCE)]
    for part in runs_of([j - i for _, i, j in pieces], PLACES_AT_ONCE):
        yield pieces[part]


def _raw_scores(model: ToxicityModel, ids: list[np.ndarray], rows: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Logit before calibration, and number of the guessed language, of each text. ``pad``: number of a row of zeros."""
    flat, bounds = _spread(ids, pad)
    top = np.full((len(ids), _OUTPUTS), -np.inf, dtype=rows.dtype)
    shares = np.zeros((len(ids), rows.shape[1] - _COLUMNS))
    for own in _pieces(bounds):
        text, begins, ends = np.array(own).T
        first, last = begins[0], ends[-1]
        seen = rows[flat[first:last + max(WIDTHS)]]
        places = np.column_stack([begins, ends]).ravel() - first
        np.maximum.at(top, text, np.maximum.reduceat(_convolved(seen[:, :_COLUMNS]), places, axis=0)[::2])
        if shares.shape[1]:
            np.add.at(shares, text, np.add.reduceat(seen[:last - first, _COLUMNS:], begins - first, axis=0))
    logit = np.maximum(top + model.bias, 0) @ model.out + model.intercept
    return logit, shares.argmax(axis=1) if shares.shape[1] else np.zeros(len(ids), dtype=np.int64)


def predict(model: ToxicityModel, texts: list[str | None], words: _Words | None = None) -> np.ndarray:
    """Score (0 to 1) of each text; null is scored as the empty text."""
    words = words or _rows_of_table(model.table)
    out = np.zeros(len(texts))
    whole = [t or "" for t in texts]
    for part in runs_of([len(t) // 6 for t in whole], BATCH_WORDS):
        ids, rows = words.numbers(whole[part])
        if words.count >= len(rows):
            rows = words.rows = np.vstack([rows, np.zeros_like(rows[:1])])
        rows[words.count] = 0
        logit, language = _raw_scores(model, ids, rows, words.count)
        out[part] = 1 / (1 + np.exp(-np.clip(logit - model.thresholds[language], -40, 40)))
    return out


def _started(odds: np.ndarray, seed: int) -> list[np.ndarray]:
    """First parameters: table, filters (one array per width: offset x dimension x filter), bias, output weights, intercept.

    ``odds``: each bucket's log odds, so that telling words lead some filters from the first step.
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    table[:, 0] = np.clip(odds, -3, 3) / 3
    table[0] = 0
    filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0] = np.abs(f[:, 0]) + 0.3
    params = [table, *filters, np.zeros(_OUTPUTS), rng.normal(0.2, 0.1, _OUTPUTS), np.zeros(1)]
    return [p.astype(np.float32) for p in params]


def _tops(wide: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's maximum in each text and its first place in ``flat``. wide: contributions of each word."""
    top = np.full((len(bounds), _OUTPUTS), -np.inf, dtype=wide.dtype)
    place = np.zeros(top.shape, dtype=np.int64)
    for own in _pieces(bounds):
        first = own[0][1]
        conv = np.ascontiguousarray(_convolved(wide[flat[first:own[-1][2] + max(WIDTHS)]]).T)
        for n, i, j in own:
            piece = conv[:, i - first:j - first]
            at = piece.argmax(axis=1)
            value = piece[np.arange(_OUTPUTS), at]
            better = value > top[n]
            top[n, better], place[n, better] = value[better], at[better] + i
    return top, place


class _Training:
    """Steps of Adam on ``params``, in place."""

    def __init__(self, params: list[np.ndarray], weight: np.ndarray) -> None:
        self.params, self.weight, self.taken = params, weight, 0
        self.first, self.second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def step(self, buckets: np.ndarray, ids: list[np.ndarray], label: np.ndarray) -> None:
        """On one mini-batch: buckets of its different words, their numbers text by text, labels."""
        table, *filters, bias, out, intercept = self.params
        flat, bounds = _spread(ids, len(buckets))
        vectors = np.vstack([_row_sums(table, buckets), np.zeros((1, DIMENSIONS), dtype=table.dtype)])
        wide = np.hstack([vectors @ f[o] for f in filters for o in range(len(f))])
        top, place = _tops(wide, flat, bounds)
        top += bias
        hidden = np.maximum(top, 0)
        logit = np.clip(hidden @ out + intercept, -MAX_LOGIT, MAX_LOGIT)
        wanted = label * (1 - SMOOTHING) + SMOOTHING / 2
        error = (self.weight[label] * (1 / (1 + np.exp(-logit)) - wanted) / len(label)).astype(table.dtype)
        inner = error[:, None] * out * (top > 0)
        grads = [np.zeros_like(p) for p in self.params]
        to_vectors = np.zeros_like(vectors)
        for k, f in enumerate(filters):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            for o in range(len(f)):
                word = flat[place[:, own] + o]
                grads[1 + k][o] = np.einsum("df,dfk->kf", inner[:, own], vectors[word])
                np.add.at(to_vectors, word, inner[:, own, None] * f[o].T)
        used = np.flatnonzero(to_vectors[:-1].any(axis=1))
        np.add.at(grads[0], buckets[used], to_vectors[used, None, :])
        grads[0][0] = 0
        grads[-3], grads[-2], grads[-1] = inner.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)
        self.taken += 1
        for p, g, m, v in zip(self.params, grads, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.01 / (1 - 0.9**self.taken) * m / (np.sqrt(v / (1 - 0.999**self.taken)) + 1e-8)


def _packed(params: list[np.ndarray]) -> np.ndarray:
    """All parameters as rows of ``DIMENSIONS``: the table's first, then the others', filled up by zeros."""
    rest = np.concatenate([p.ravel() for p in params[1:]])
    filled = np.zeros((-(-len(rest) // DIMENSIONS), DIMENSIONS), dtype=rest.dtype)
    filled.ravel()[:len(rest)] = rest
    return np.vstack([params[0], filled])


def _unpacked(rows: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    ends = np.cumsum([p.size for p in like[1:]])
    parts = np.split(rows[BUCKETS:].ravel()[:ends[-1]], ends[:-1])
    return [rows[:BUCKETS].copy(), *(x.reshape(p.shape).copy() for x, p in zip(parts, like[1:], strict=True))]


def _encoded(labelled: DataFrame) -> DataFrame:
    """(doc_id, lang, text, toxic) as mini-batches of one shard and one part (``held``: for the thresholds) each.

    A shard is a partition of ``labelled``.  Columns: labels (uint8) and langs of the texts, their numbers of words (int64), buckets of the different words (int16, in order
    of appearance) and all words as numbers of these (int32).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_by_worker(("toxicity_cnn", "buckets"), lambda: _Words(lambda buckets: buckets.astype(np.int16)))
        for batch in batches:
            held, toxic, lang, text = (batch.column(c).to_pylist() for c in ("held", "toxic", "lang", "text"))
            ends = [i for i in range(1, len(text)) if held[i] != held[i - 1]]
            for begin, end in zip([0, *ends], [*ends, len(text)], strict=True):
                for part in runs_of([max(len(t) // 6, BATCH_WORDS // BATCH_DOCS) for t in text[begin:end]], BATCH_WORDS):
                    own = slice(begin + part.start, begin + part.stop)
                    ids, rows = known.numbers(text[own])
                    used, first, words = np.unique(np.concatenate(ids), return_index=True, return_inverse=True)
                    order = np.argsort(first)
                    rank = np.empty(len(order), dtype=np.int32)
                    rank[order] = np.arange(len(order))
                    columns = [TaskContext.get().partitionId(), held[begin], bytes(toxic[own]), lang[own],
                               np.array([len(x) for x in ids], dtype="<i8").tobytes(),
                               rows[used[order]].astype("<i2").tobytes(), rank[words].astype("<i4").tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.string()),
                                                                    pa.binary(), pa.binary(), pa.binary()), strict=True)],
                        [f.split()[0] for f in _BATCHES.split(", ")])

    order = ["held", F.xxhash64("doc_id", "text"), "doc_id"]
    return written(labelled.withColumn("held", _held(F.col("doc_id"))).sortWithinPartitions(*order)
                   .select("held", "toxic", "lang", "text").mapInArrow(run, _BATCHES), "toxicity")


def _labelled(docs: DataFrame, known: DataFrame, shards: int) -> DataFrame:
    """(doc_id, lang, text, toxic) of the labelled documents with a text, dealt out to ``shards`` partitions by doc_id.

    Most other documents are left out before their texts are shuffled, by a bitmap of the labelled ids' hashes.
    """
    slot = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(ID_SLOTS))
    maps = known.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = (docs.select("doc_id", "lang", "text").where(F.col("text").isNotNull())
              .join(F.broadcast(maps), F.bitmap_bucket_number(slot) == F.col("part"))  # ID_SLOTS bits at most
              .where(F.getbit(byte, (at % 8).cast("int")) == 1).select("doc_id", "lang", "text"))
    return likely.repartition(shards, "doc_id").join(known.repartition(shards, "doc_id"), "doc_id")


def _held(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string"), F.lit(4)), F.lit(4)) == 3


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, np.ndarray, list, np.ndarray, list[np.ndarray]]]:
    """(shard, held, labels, langs, buckets of the different words, their numbers text by text) of each mini-batch."""
    for batch in batches:
        for n in range(batch.num_rows):
            shard, held, labels, langs, sizes, vocabulary, words = (c[n].as_py() for c in batch.columns)
            bounds = np.cumsum(np.frombuffer(sizes, "<i8"))
            yield (shard, held, np.frombuffer(labels, np.uint8).astype(np.int64), langs,
                   np.frombuffer(vocabulary, "<i2").reshape(-1, _FEATURES), np.split(np.frombuffer(words, "<i4"), bounds[:-1]))


def _counts(encoded: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by (part, class); documents to train on by (class, bucket); features of all words by (bucket, language)."""
    place = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = np.zeros((2, 2), dtype=np.int64)
        found = np.zeros((2 + len(languages), BUCKETS), dtype=np.int64)
        for _, held, labels, langs, buckets, ids in _decoded(batches):
            docs[int(held)] += np.bincount(labels, minlength=2)
            for y, lang, words in zip(labels.tolist(), langs, ids, strict=True):
                used, times = np.unique(words, return_counts=True)
                own = buckets[used]
                if not held:
                    found[y, np.unique(own)] += 1
                if lang is not None:
                    to = found[2 + place.get(lang, len(languages) - 1)]
                    np.add.at(to, own.ravel(), np.repeat(times, _FEATURES))
        kinds, buckets = found.nonzero()
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(np.concatenate([[-1] * 4, kinds]), pa.int32()),
            "bucket": pa.array(np.concatenate([np.arange(4), buckets]), pa.int32()),
            "n": pa.array(np.concatenate([docs.ravel(), found[kinds, buckets]]), pa.int64())})

    rows = (encoded.mapInArrow(run, "kind int, bucket int, n bigint").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
            .toArrow())  # at most a row per bucket and class or language
    kind, bucket, n = (rows.column(c).to_numpy() for c in ("kind", "bucket", "n"))
    out = np.zeros((3 + len(languages), BUCKETS), dtype=np.int64)
    out[kind + 1, bucket] = n
    return out[0, :4].reshape(2, 2), out[1:3], out[3:].T


def _pass(encoded: DataFrame, params: list[np.ndarray], weight: np.ndarray) -> list[np.ndarray]:
    """Each shard trains from ``params`` on all its documents; the mean of what they find.

    A bucket's row is weighted by how often the shard's mini-batches hold it, and stays where none does; the other
    parameters are weighted by documents.
    """
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast((params, weight))
    values = [f"v{k}" for k in range(DIMENSIONS)]

    def found(training: _Training, times: np.ndarray) -> pa.RecordBatch:
        rows = _packed(training.params)
        at = times.nonzero()[0]
        units = np.rint(rows[at].astype(np.float64) / PARAMETER_UNIT).astype(np.int64) * times[at, None]
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(times[at]), *map(pa.array, np.ascontiguousarray(units.T))],
                                          ["place", "times", *values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, weight = shared.value
        size = len(_packed(start))
        for _, own in itertools.groupby(_decoded(batches), lambda r: r[0]):
            training, times = _Training([p.copy() for p in start], weight), np.zeros(size, dtype=np.int64)
            for _, _, label, _, buckets, ids in own:
                training.step(buckets, ids, label)
                times[:BUCKETS] += np.bincount(buckets.ravel(), minlength=BUCKETS)
                times[BUCKETS:] += len(label)
            yield found(training, times)

    schema = ", ".join(["place int", "times bigint", *(f"{v} bigint" for v in values)])
    rows = (encoded.where(~F.col("held")).mapInArrow(run, schema).groupBy("place")
            .agg(*(F.sum(c).alias(c) for c in ("times", *values))).toArrow())  # a row per bucket or so
    shared.unpersist()
    packed = _packed(params)
    total = np.column_stack([rows.column(v).to_numpy() for v in values])
    packed[rows.column("place").to_numpy()] = total / rows.column("times").to_numpy()[:, None] * PARAMETER_UNIT
    packed[0] = 0
    return _unpacked(packed, params)


def _logits(encoded: DataFrame, model: ToxicityModel) -> tuple[np.ndarray, ...]:
    """(guessed language, logit, label, documents) of all documents for the thresholds, logits in steps of ``LOGIT_UNIT``."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for _, _, label, _, buckets, ids in _decoded(batches):
            rows = np.vstack([_row_sums(model.table, buckets), np.zeros((1, model.table.shape[1]), dtype=model.table.dtype)])
            logit, language = _raw_scores(model, ids, rows, len(buckets))
            steps = np.rint(np.clip(logit, -MAX_LOGIT, MAX_LOGIT) / LOGIT_UNIT)
            yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), pa.array(steps.astype(np.int32)), pa.array(label, pa.int32())],
                                             ["language", "logit", "label"])

    rows = (encoded.where("held").mapInArrow(run, "language int, logit int, label int").groupBy("language", "logit", "label")
            .agg(F.count("*").alias("n")).orderBy("language", "logit", "label").toArrow())  # bounded by the steps
    shared.unpersist()
    language, logit, label, n = (rows.column(c).to_numpy() for c in ("language", "logit", "label", "n"))
    return language, logit * LOGIT_UNIT, label, n


def _threshold(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """Logit that maximises F1 of the weighted rows: the middle between two neighbours."""
    order = np.argsort(-logit, kind="stable")
    hit, all_ = np.cumsum(weight[order] * label[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + hit[-1])
    f1[:-1][logit[order][1:] == logit[order][:-1]] = -1
    best = int(f1.argmax())
    after = logit[order][best + 1] if best + 1 < len(order) else logit[order][best] - 1
    return float((logit[order][best] + after) / 2)


def _warmed(params: list[np.ndarray], texts: list[str], label: np.ndarray, seed: int) -> None:
    """Trains ``params`` in place on the texts of a bounded sample, on the driver."""
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    ids = [np.array([number.setdefault(w, len(number)) for w in t.split()], dtype=np.int32) for t in texts]
    buckets = _features_of([_core(w) for w in number])
    training = _Training(params, np.ones(2))
    for _ in range(EPOCHS):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), BATCH_DOCS):
            chosen = order[at:at + BATCH_DOCS]
            used, words = np.unique(np.concatenate([ids[i] for i in chosen]), return_inverse=True)
            bounds = np.cumsum([len(ids[i]) for i in chosen])
            training.step(buckets[used], np.split(words.astype(np.int32), bounds[:-1]), label[chosen])


def _sample(docs: DataFrame, known: DataFrame, docs_per_class: int) -> list[tuple[str, int]]:
    """(text, label) of a bounded sample of both classes: all that reaches the driver of texts."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [r for y in (0, 1) for r in known.where(F.col("toxic") == y).orderBy(*order).limit(docs_per_class).collect()]
    chosen = docs.sparkSession.createDataFrame(picked, known.schema)  # at most 2 * docs_per_class ids
    texts = (docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
             .select("doc_id", "toxic", F.substring("text", 1, MAX_CHARS_A_TEXT).alias("text"), F.xxhash64("text").alias("hash")))
    rows = (texts.select("doc_id", "toxic", "hash", F.length("text").alias("size"))
            .orderBy(*order, "hash").limit(2 * docs_per_class).collect())
    fitting, room = [], MAX_WORDS_FITTED
    for r in rows:
        n = r["size"] // 6
        if n <= room:
            fitting.append(r)
            room -= n
    wanted = docs.sparkSession.createDataFrame(
        list({(r["doc_id"], r["hash"]) for r in fitting}), texts.select("doc_id", "hash").schema)
    text = {(r["doc_id"], r["hash"]): r["text"] for r in texts.join(F.broadcast(wanted), ["doc_id", "hash"])
            .select("doc_id", "hash", "text").dropDuplicates(["doc_id", "hash"]).collect()}
    return [(text[r["doc_id"], r["hash"]], r["toxic"]) for r in fitting]


def fit(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS, seed: int = 7) -> ToxicityModel:
    """A model from documents (doc_id, text, lang) and labels (doc_id, toxic: 0 or 1).

    Labels with null doc_id or toxic are not used; of several labels of a document the largest counts; null texts are left
    out.  All other labelled documents are used with their whole texts: three in four train the network, the others set the
    thresholds, and all tell the languages apart.  Both classes weigh the same in training.

    Only the network's start is from a bounded sample: of each class the ``docs_per_class`` ids with the smallest hash (ties:
    smallest id), and of their texts (the first ``MAX_CHARS_A_TEXT`` characters of a longer one), in that order, those that
    fit into ``MAX_WORDS_FITTED`` words of six characters together.  Only these texts reach the driver.

    Without rows of both classes to train on and for the thresholds every score is that of a constant: 0.
    """
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(F.col("toxic").isin(0, 1)))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    constant = ToxicityModel(np.zeros((BUCKETS, _COLUMNS), np.float32), np.zeros(_OUTPUTS), np.zeros(_OUTPUTS), -40.0, [], np.zeros(1))
    if len(totals) < 2:
        return constant
    encoded = _encoded(_labelled(docs, known, -(-sum(totals.values()) // DOCS_PER_SHARD)))
    frequent = [r["lang"] for r in encoded.select(F.explode("langs").alias("lang")).where(F.col("lang").isNotNull())
                .groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()]
    languages = sorted(frequent[:MAX_LANGUAGES]) + [OTHER_LANGUAGES] * (len(frequent) > MAX_LANGUAGES)
    by_class, holding, features = _counts(encoded, languages)
    if not by_class.all():
        return constant
    params = _started(np.log((holding[1] + 1) / by_class[0, 1]) - np.log((holding[0] + 1) / by_class[0, 0]), seed)
    sample = _sample(docs, known.where(~_held(F.col("doc_id"))), docs_per_class)
    label = np.array([y for _, y in sample], dtype=np.int64)
    if len(set(label.tolist())) == 2:
        _warmed(params, [t for t, _ in sample], label, seed)
    weight = by_class[0].sum() / (2 * by_class[0])
    for _ in range(PASSES):
        params = _pass(encoded, params, weight)
    table, *filters, bias, out, intercept = [p.astype(np.float64) for p in params]

    shares = 0.5 + features
    shares = np.log(shares / shares.sum(axis=0))
    shares -= shares.mean(axis=1, keepdims=True)
    shares[0] = 0
    wide = np.hstack([*(table @ f[o] for f in filters for o in range(len(f))), shares]).astype(np.float32)
    model = ToxicityModel(wide, bias, out, float(intercept[0]), languages, np.zeros(max(1, len(languages))))

    language, logit, y, n = _logits(encoded, model)
    overall = _threshold(logit, y, n)
    for k in range(len(model.thresholds)):
        own = language == k
        # a language needs some rows of each class for a threshold of its own
        enough = min(n[own & (y == 1)].sum(), n[own & (y == 0)].sum()) >= 10
        model.thresholds[k] = _threshold(logit[own], y[own], n[own]) if enough else overall
    model.calibration = {name: float(t) for name, t in zip(languages, model.thresholds, strict=False)}
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with score (double, 0 to 1) and predicted (1 if score >= 0.5, else 0) behind its columns.

    One row per input row; null text is scored as the empty text.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        words = kept_by_worker(("toxicity_cnn", name), lambda: _rows_of_table(shared.value.table))
        for batch in batches:
            found = predict(shared.value, batch.column(text).to_pylist(), words)
            yield batch, [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32), pa.int32())]

    return appending(docs, FIELDS, compute)
