"""Token ids of many texts with the tokenizers library, each distinct stretch of text encoded once.

A byte-level BPE tokenizer splits a text into pre-tokens and merges inside each
of them.  A space between two characters that are not white space always begins
a pre-token, and a line end between two such characters is one, so texts can be
cut there, the stretches encoded apart and the ids joined.  Stretches repeat, so
their ids are kept (for a bounded number of them).
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickframe.llm._common import kept_by_worker, starts_of

KEPT_STRETCHES = 800_000
KEPT_MARKS = 20_000
ENCODED_AT_ONCE = 20_000

_CUT = re.compile(r"(?<=\S)(?= \S)")
_SPACE = re.compile(r"\s")
#: White space other than single spaces and line ends between other characters (for Arrow's regular expressions).
_UNEVEN = (r"[ \n][ \n]|\A[ \n]|[ \n]\z|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
#: ASCII marks behind a Latin letter up to the end of a stretch are a pre-token of their own (an apostrophe may begin a contraction).
_MARKED = r"^(?P<stem>[^\n].*[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])[!-&(-/:-@\[-`{-~]+\z"
#: Keys of kept stretches: as they are behind a space, with this before them at the begin of a text or line.
BEGIN = "\n"
LINE_END = "\n\n"


def default_tokenizer() -> str:
    """Path of the public 50k byte-level BPE tokenizer installed with the tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts; ``dtype`` is the smallest unsigned type that holds the vocabulary."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a text with a special token's string is encoded whole, as the library splits it there first
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        line_end = self._ids(["\n"])[0]
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.marks: dict[str, bytes] = {}  # of the latest texts
        # the kept stretches: keys, and the ids of the i-th from starts[i] to starts[i + 1] of `flat`
        self.keys = pa.array([BEGIN, LINE_END], pa.large_string())
        self.starts = np.array([0, 0, len(line_end)], dtype=np.int64)
        self.flat = np.array(line_end, dtype=self.dtype)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of different stretches, with ``lead`` before each."""
        known: dict[str, bytes] = {}
        width = self.dtype.itemsize
        # stretches without white space go through the tokenizer as lines of one text: a line end is a token of its own
        plain = [s for s in words if s and not _SPACE.search(s)] if self.line_end is not None else []
        for at in range(0, len(plain), ENCODED_AT_ONCE):
            part = plain[at:at + ENCODED_AT_ONCE]
            ids = np.array(self._ids(["\n".join(lead + s for s in part)])[0], dtype=np.int64)
            ends = [*np.flatnonzero(ids == self.line_end).tolist(), len(ids)]
            raw, begin = ids.astype(self.dtype).tobytes(), 0
            for s, end in zip(part, ends, strict=True):
                known[s] = raw[begin * width:end * width]
                begin = end + 1
        rest = [s for s in words if s not in known]
        known.update(zip(rest, map(self._bytes, self._ids([lead + s for s in rest])), strict=True))
        return [known[s] for s in words]

    def _kept(self, place: int) -> bytes:
        return self.flat[self.starts[place]:self.starts[place + 1]].tobytes()

    def _add(self, new: list[str], stems: dict[str, str], kept: dict[str, int]) -> None:
        """Learns different keys that are not kept, and keeps them in their order.

        ``stems``: those of them that end in marks, without these; ``kept``: where the stems that are kept are.
        """
        begin = [k[1:] for k in new if k[0] == BEGIN]
        inner = [k for k in new if k[0] != BEGIN]
        plain = [s for s in inner if s not in stems]
        more = list({s for s in stems.values() if s not in kept}.difference(plain))
        ids = dict(zip(plain + more, self._learned(plain + more, " "), strict=True))
        begin_ids = dict(zip(begin, self._learned(begin, ""), strict=True))
        marks = list({k[len(s):] for k, s in stems.items()}.difference(self.marks))
        self.marks.update(zip(marks, map(self._bytes, self._ids(marks)), strict=True))
        ids |= {s: self._kept(at) for s, at in kept.items()}
        values = [begin_ids[k[1:]] if k[0] == BEGIN else ids[stems[k]] + self.marks[k[len(stems[k]):]] if k in stems else ids[k] for k in new]
        values += [ids[s] for s in more]
        sizes = np.array([len(v) for v in values], dtype=np.int64) // self.dtype.itemsize
        self.keys = pa.concat_arrays([self.keys, pa.array(new + more, pa.large_string())])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(values), dtype=self.dtype)])

    def _places(self, keys: pa.Array) -> np.ndarray:
        """Where different keys are kept; unknown ones are learned together."""
        # the stems of keys with marks are looked up with the keys: each look-up hashes all that is kept
        stem = pc.struct_field(pc.extract_regex(keys, _MARKED), "stem")
        marked = np.flatnonzero(stem.is_valid().to_numpy(zero_copy_only=False))
        stem = stem.drop_null()
        found = pc.index_in(pa.concat_arrays([keys, stem]), value_set=self.keys).fill_null(-1).to_numpy().astype(np.int64)
        out, stem_at = found[:len(keys)].copy(), found[len(keys):]
        holes = np.flatnonzero(out < 0)
        if len(holes):
            new = keys.take(pa.array(holes)).to_pylist()
            unknown = np.flatnonzero(out[marked] < 0)
            parts = stem.take(pa.array(unknown)).to_pylist()
            stems = dict(zip(keys.take(pa.array(marked[unknown])).to_pylist(), parts, strict=True))
            kept = {s: at for s, at in zip(parts, stem_at[unknown].tolist(), strict=True) if at >= 0}
            out[holes] = len(self.keys) + np.arange(len(holes))
            self._add(new, stems, kept)
        return out

    def _uneven_keys(self, text: str) -> list[str]:
        """Keys of the stretches of a text with white space of any kind."""
        stretches = _CUT.split(text)
        keys = [stretches[0], *(s[1:] for s in stretches[1:])]
        if keys[0][:1] == " " and len(keys[0]) > 1 and not keys[0][1].isspace():
            keys = ["", keys[0][1:], *keys[1:]]
        keys[0] = BEGIN + keys[0]
        return keys

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text (strings without nulls) as little-endian bytes of ``dtype``."""
        if len(self.marks) > KEPT_MARKS:
            self.marks.clear()
        # the first stretches seen are the frequent ones: of too many the later half goes
        if len(self.keys) > KEPT_STRETCHES:
            half = max(2, KEPT_STRETCHES // 2)
            self.keys, self.starts = pa.concat_arrays([self.keys.slice(0, half)]), self.starts[:half + 1].copy()
            self.flat = self.flat[:self.starts[-1]].copy()
        out: list[bytes] = [b""] * len(texts)
        whole = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(whole, _UNEVEN).to_numpy(zero_copy_only=False)
        if self.line_end is None:
            uneven |= pc.match_substring(whole, "\n").to_numpy(zero_copy_only=False)
        special = np.zeros(len(texts), dtype=bool)
        for s in self.special:
            special |= pc.match_substring(whole, s).to_numpy(zero_copy_only=False)
        for n in np.flatnonzero(special).tolist():
            out[n] = self._bytes(self._ids([whole[n].as_py()])[0])
        rest = np.flatnonzero(uneven & ~special).tolist()
        if rest:
            keys = [self._uneven_keys(whole[n].as_py()) for n in rest]
            different = list({k for own in keys for k in own})
            ids = dict(zip(different, map(self._kept, self._places(pa.array(different, whole.type)).tolist()), strict=True))
            for n, own in zip(rest, keys, strict=True):
                out[n] = b"".join(map(ids.__getitem__, own))
        rest = np.flatnonzero(~uneven & ~special)
        if len(rest):
            # all stretches of all texts at once: the different ones are looked up, the ids gathered
            text = whole.type
            lines = pc.replace_substring(whole.take(pa.array(rest)), "\n", f" {LINE_END} {BEGIN}")
            keys = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(BEGIN, text), lines, pa.scalar("", text)), " ")
            coded = keys.flatten().dictionary_encode()
            place = self._places(coded.dictionary)[coded.indices.to_numpy()]
            begin = self.starts[place]
            size = self.starts[place + 1] - begin
            ends = starts_of(size)
            # place of each id in `flat`: the begin of its stretch, and its number within
            kind = np.int32 if max(ends[-1], len(self.flat)) < 2**31 else np.int64
            raw = self.flat[np.arange(ends[-1], dtype=kind) + np.repeat((begin - ends[:-1]).astype(kind), size)].tobytes()
            bounds = (ends[keys.offsets.to_numpy()] * self.dtype.itemsize).tolist()
            for n, i, j in zip(rest.tolist(), bounds[:-1], bounds[1:], strict=True):
                out[n] = raw[i:j]
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return kept_by_worker(("tokens", path), lambda: Encoder(path))
