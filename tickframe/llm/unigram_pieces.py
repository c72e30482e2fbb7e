"""Unigram encoding into pieces: Viterbi over a double-array trie, byte fallback, white-space markers.

A text becomes a marker, then the text with each space as a marker.  Of all ways
to cut it into pieces of the vocabulary the one with the largest sum of log
scores is taken.  A character that is no piece by itself may be covered at a
penalty and then becomes its UTF-8 bytes' pieces.  Decoding joins the pieces'
bytes and turns markers back into spaces.

Pieces never cross from another character to a marker (checked when the
vocabulary is read), so a text can be cut before each run of markers and the
stretches encoded apart.  New stretches are encoded together: all places of all
of them walk the trie at once, and the best cut is found place by place with
numpy.  Their ids are kept, for a bounded number of stretches.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickframe.llm._common import appending, kept_by_worker, runs_of, starts_of

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_STRETCHES = 150_000
#: Longer stretches are encoded anew each time: what is kept has a bounded size.
LONGEST_KEPT = 200
BATCH_CHARS = 1_000_000
NEW_AT_ONCE = 100_000

_CUT = re.compile(r"(?<=[^ ▁])(?=[ ▁])")
FIELDS = [T.StructField("pieces", T.BinaryType())]
TRIP_FIELDS = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id. kind: "piece", "byte" or "control" (never produced, decoded to nothing)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[str, ...]
    unknown: int


def read_vocabulary(path: str | None = None) -> Vocabulary:
    """The vocabulary of a sentencepiece model file (default: the public 32k one); its scores serve as log scores."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = tuple("byte" if model.is_byte(i) else "control" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
                  else "piece" for i in ids)
    return Vocabulary(tuple(map(model.id_to_piece, ids)), tuple(map(model.get_score, ids)), kinds, model.unk_id())


class DoubleArray:
    """A trie over bytes: the child of node s by byte c is t = base[s] + c + 1 if check[t] is s. value: id at a node, or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]) -> None:
        nodes: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, number in keys:
            at = 0
            for c in key:
                if c not in nodes[at]:
                    nodes[at][c] = len(nodes)
                    nodes.append({})
                at = nodes[at][c]
            ends.setdefault(at, number)  # of equal pieces the first
        size = 2 * len(nodes) + 600
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, dtype=bool)
        free[:258] = False  # so that any code's base is positive
        place, low = np.zeros(len(nodes), np.int64), 258
        for node, moves in enumerate(nodes):  # parents come before children
            here = int(place[node])
            self.value[here] = ends.get(node, -1)
            if not moves:
                continue
            while not free[low]:
                low += 1
            if low + 2048 > len(free):
                self._grow()
                free = np.concatenate([free, np.ones(len(self.base) - len(free), dtype=bool)])
            if len(moves) == 1:  # most nodes: the child takes the first free place behind its code
                (c, child), = moves.items()
                self.base[here] = low - c - 1
                free[low], self.check[low], place[child] = False, here, low
                continue
            codes = np.fromiter(moves, dtype=np.int64) + 1
            start = low - int(codes.max())
            while True:  # the first base from which all children's places are free
                if start + 1024 + 257 > len(free):
                    self._grow()
                    free = np.concatenate([free, np.ones(len(self.base) - len(free), dtype=bool)])
                fits = np.ones(1024, dtype=bool)
                for c in codes.tolist():
                    fits &= free[start + c:start + c + 1024]
                if fits.any():
                    base = start + int(fits.argmax())
                    break
                start += 1024
            self.base[here] = base
            for c, child in moves.items():
                at = base + c + 1
                free[at], self.check[at], place[child] = False, here, at
        last = int(np.flatnonzero(~free).max()) + 258
        self.base, self.check, self.value = self.base[:last], self.check[:last], self.value[:last]

    def _grow(self) -> None:
        more = len(self.base)
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
        self.value = np.concatenate([self.value, np.full(more, -1, np.int32)])

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        to = np.minimum(self.base[state] + byte.astype(np.int32) + 1, len(self.check) - 1)
        return np.where((self.check[to] == state) & (to > 0), to, -1)


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        own = [i for i, k in enumerate(vocabulary.kinds) if k == "piece"]
        self.trie = DoubleArray([(vocabulary.pieces[i].encode(), i) for i in own if vocabulary.pieces[i]])
        self.score = np.array(vocabulary.scores, dtype=np.float64)
        self.penalty = min((vocabulary.scores[i] for i in own), default=0.0) - UNKNOWN_PENALTY
        self.bytes_from = {int(vocabulary.pieces[i][3:5], 16): i for i, k in enumerate(vocabulary.kinds) if k == "byte"}
        self.unknown = vocabulary.unknown
        self.dtype = np.dtype("<u2" if len(vocabulary.pieces) <= 1 << 16 else "<u4")
        self.cuts = not any(re.search(f"[^{MARKER}]{MARKER}", vocabulary.pieces[i]) for i in own)
        text = [p.replace(MARKER, " ").encode() if k == "piece" else bytes([int(p[3:5], 16)]) if k == "byte" else b""
                for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True)]
        text[self.unknown] = " ⁇ ".encode()
        self.text = text
        self.known: dict[str, bytes] = {}

    def _fallback(self, char: bytes) -> list[int]:
        if len(self.bytes_from) == 256:
            return [self.bytes_from[b] for b in char]
        return [self.unknown]

    def viterbi(self, stretches: list[bytes]) -> list[list[int]]:
        """Ids of each stretch (UTF-8, markers in place). Of equal sums the one whose last piece is longest wins."""
        lengths = np.array([len(s) for s in stretches], dtype=np.int64)
        starts = starts_of(lengths)
        text = np.frombuffer(b"".join(stretches) + b"\0", dtype=np.uint8)
        total = int(starts[-1])
        owner = np.repeat(np.arange(len(stretches)), lengths)
        begin = np.flatnonzero((text[:total] & 0xC0) != 0x80)
        lead = text[begin]
        width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
        # all places walk the trie together; a piece found is an edge from its begin to its end
        at, state, end = begin, np.zeros(len(begin), dtype=np.int64), starts[1:][owner[begin]]
        edges, single, depth = [], np.zeros(total + 1, dtype=bool), 0
        one = np.zeros(total + 1, dtype=np.int64)
        one[begin] = width
        while len(at):
            state = self.trie.step(state, text[at + depth])
            depth += 1
            go = state >= 0
            at, state, end = at[go], state[go], end[go]
            value = self.trie.value[state]
            hit = value >= 0
            edges.append((at[hit], at[hit] + depth, value[hit]))
            single[at[hit][one[at[hit]] == depth]] = True
            more = at + depth < end
            at, state, end = at[more], state[more], end[more]
        lost = ~single[begin]
        edges.append((begin[lost], begin[lost] + width[lost], np.full(int(lost.sum()), -1)))
        source, target, piece = (np.concatenate(c) for c in zip(*edges, strict=True))
        worth = np.where(piece >= 0, self.score[piece], self.penalty)
        # forward by places of the stretches: an edge's begin is settled before its end; +1 sets stretches' ends apart
        number = owner[source]
        first, last = source + number, target + number
        relative = target - starts[number]
        order = np.lexsort((source, relative))
        first, last, piece, worth, relative = first[order], last[order], piece[order], worth[order], relative[order]
        best = np.full(total + len(stretches), -np.inf)
        best[starts[:-1] + np.arange(len(stretches))] = 0
        back, taken = np.full(len(best), -1, dtype=np.int64), np.full(len(best), -1, dtype=np.int64)
        bounds = np.searchsorted(relative, np.arange(1, int(lengths.max()) + 2 if len(lengths) else 1))
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if i == j:
                continue
            sums = best[first[i:j]] + worth[i:j]
            np.maximum.at(best, last[i:j], sums)
            # the earliest begin among the best: written last
            won = np.flatnonzero(sums == best[last[i:j]])[::-1]
            back[last[i:j][won]], taken[last[i:j][won]] = first[i:j][won], piece[i:j][won]
        out = []
        for n, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            ids, spot, base = [], b + n, a + n
            while spot > base:
                before = int(back[spot])
                if taken[spot] >= 0:
                    ids.append(int(taken[spot]))
                else:
                    ids += self._fallback(text[before - n:spot - n].tobytes())[::-1]
                spot = before
            out.append(ids[::-1])
        return out

    def _stretches(self, text: str) -> list[str]:
        """A marked text cut before each run of markers; spaces stand for markers."""
        if not self.cuts:
            return [text]
        if "  " in text or MARKER in text or text[-1:] == " ":
            return _CUT.split(text)
        return [f" {s}" for s in text.split(" ")[1:]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``; the empty text has none."""
        cut = [self._stretches(" " + t) if t else [] for t in texts]
        if len(self.known) > KEPT_STRETCHES:
            first = list(islice(self.known.items(), KEPT_STRETCHES // 2))
            self.known.clear()
            self.known.update(first)
        new = list({s for own in cut for s in own}.difference(self.known))
        for part in runs_of([len(s) for s in new], NEW_AT_ONCE):
            raw = [s.replace(" ", MARKER).encode("utf-8", "replace") for s in new[part]]
            for s, ids in zip(new[part], self.viterbi(raw), strict=True):
                self.known[s] = np.array(ids, dtype=self.dtype).tobytes()
        known = self.known.__getitem__
        out = [b"".join(map(known, own)) for own in cut]
        for s in new:
            if len(s) > LONGEST_KEPT:
                del self.known[s]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        numbers = np.frombuffer(ids, dtype=self.dtype).tolist()
        text = b"".join(map(self.text.__getitem__, numbers)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _kept(enc: Encoder, name: str) -> Encoder:
    """The encoder with the stretches that the worker keeps; a broadcast value of an earlier run must not hold them."""
    enc.known = kept_by_worker(("unigram_pieces", name), dict)
    return enc


def _coded(enc: Encoder, column: pa.Array) -> Iterator[tuple[slice, list[str | None], list[bytes | None]]]:
    """Texts of a column and their ids (``dtype``; null for a null text), by parts of bounded size."""
    sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
    for part in runs_of(sizes, BATCH_CHARS):
        texts = column.slice(part.start, part.stop - part.start).to_pylist()
        raw = enc.encode([t or "" for t in texts])
        yield part, texts, [r if t is not None else None for r, t in zip(raw, texts, strict=True)]


def encode(docs: DataFrame, encoder: Encoder, text: str = "text") -> DataFrame:
    """``docs`` with pieces (ids as little-endian unsigned 32-bit integers) behind its columns.

    A null text has null pieces, an empty one none.  One row per input row; an input column ``pieces`` is replaced.  A
    marker (U+2581) in a text is taken for a space, as it is in a piece, and comes back as one.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(encoder), uuid.uuid4().hex  # as large as its vocabulary

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        enc = _kept(shared.value, name)
        try:
            for batch in batches:
                for part, _, coded in _coded(enc, batch.column(text)):
                    wide = [np.frombuffer(r, dtype=enc.dtype).astype("<u4").tobytes() if r is not None else None for r in coded]
                    yield batch.slice(part.start, part.stop - part.start), [pa.array(wide, pa.binary())]
        finally:
            enc.known = {}

    return appending(docs, FIELDS, compute)


def decode(docs: DataFrame, encoder: Encoder, pieces: str = "pieces", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of its column ``pieces`` in ``into``; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(encoder)  # as large as its vocabulary

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        enc = shared.value
        for batch in batches:
            raw = batch.column(pieces).to_pylist()
            yield batch, [pa.array([enc.decode(np.frombuffer(r, dtype="<u4").astype(enc.dtype).tobytes()) if r is not None else None
                                    for r in raw], pa.string())]

    return appending(docs, [T.StructField(into, T.StringType())], compute)


def round_trips(docs: DataFrame, encoder: Encoder, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_pieces, ids_crc32 (of the ids as ``encode`` writes them) and round_trip behind.

    round_trip: whether the ids decode to the text.  A null text has null for the first two and comes back as null.  Texts
    are encoded, decoded and compared in one pass, so that neither ids nor texts leave the worker.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(encoder), uuid.uuid4().hex  # as large as its vocabulary

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        enc = _kept(shared.value, name)
        try:
            for batch in batches:
                counts, sums, same = [], [], []
                for _, texts, coded in _coded(enc, batch.column(text)):
                    counts += [len(r) // enc.dtype.itemsize if r is not None else None for r in coded]
                    sums += [zlib.crc32(np.frombuffer(r, dtype=enc.dtype).astype("<u4")) if r is not None else None for r in coded]
                    same += [r is None or enc.decode(r) == t for r, t in zip(coded, texts, strict=True)]
                yield batch, [pa.array(counts, pa.int64()), pa.array(sums, pa.int64()), pa.array(same, pa.bool_()),
                              pa.nulls(batch.num_rows, pa.string())]
        finally:
            enc.known = {}

    return appending(docs, [*TRIP_FIELDS, T.StructField(text, T.StringType())], compute).drop(text)
