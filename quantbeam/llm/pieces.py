"""Fast exact encoding with a byte-level BPE file of the ``tokenizers`` library.

The library splits a text by a fixed pattern and encodes each piece on its
own. ``PieceEncoder`` finds the pattern's pieces of a whole batch with array
operations, lets the library encode the pieces that it has not met lately, and
keeps their ids. Ids are therefore the library's; the memory for pieces is
bounded by ``max_pieces``.

Texts that hold a special string or a character beyond Latin Extended-A, where
two versions of Unicode tables might class a character differently, go to the
library whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Characters below are classed here; two bytes in UTF-8 at most.
KNOWN = 0x180
LETTER, NUMBER, BLANK, OTHER = range(4)
#: Classes of the split pattern: letters, numbers, white space, the rest.
CLASS = np.array([LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c)
                  else BLANK if regex.match(r"\s", c) else OTHER for c in map(chr, range(KNOWN))], np.uint8)
FIRST_UNKNOWN = 0xC0 | KNOWN >> 6     # the first byte of characters from KNOWN on
# What follows an apostrophe in a contraction.
SHORT = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


@functools.lru_cache(maxsize=4)
def load(path: str):
    """The library's tokenizer; no threads of its own beside Spark's tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    """The special strings of a byte-level BPE file. Raises for other kinds,
    for which splitting by the pattern would not be exact."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
            or spec.get("normalizer") or spec.get("post_processor") or spec.get("truncation"):
        raise ValueError(f"{path}: not a plain byte-level BPE file")
    added = spec.get("added_tokens") or []
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
        raise ValueError(f"{path}: added tokens that take in their surroundings")
    return tuple(a["content"] for a in added)


def piece_starts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin in UTF-8 texts that stand one after another in
    ``raw`` and end at ``ends``; all characters below ``KNOWN``.

    Pieces are runs of one class of characters, with these exceptions: a space
    before a run that is not white space belongs to that run; of several white
    characters before such a run the last parts from the others; an apostrophe
    that no space precedes takes a contraction's letters.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.int64)
    kind = np.append(CLASS[np.minimum(raw, 0x7F)], OTHER)
    lead = np.flatnonzero(raw >= 0xC0)
    wide = CLASS[(raw[lead].astype(np.int64) & 0x1F) << 6 | raw[lead + 1] & 0x3F]
    kind[lead] = kind[lead + 1] = wide
    top = np.zeros(n + 1, bool)               # a text begins here
    top[0] = True
    top[ends] = True
    run = top.copy()                          # a run begins here
    run[1:] |= kind[1:] != kind[:-1]
    start = run[:n].copy()

    solid = np.flatnonzero(run[:n] & (kind[:n] != BLANK) & ~top[:n])
    after_blank = solid[kind[solid - 1] == BLANK]
    two_bytes = raw[after_blank - 1] >= 0x80
    start[after_blank - 1 - two_bytes] = True
    start[after_blank[raw[after_blank - 1] == 0x20]] = False

    quote = np.flatnonzero(raw == 0x27)
    quote = quote[run[quote] & run[quote + 1] & ~top[quote + 1] & (kind[quote + 1] == LETTER)]
    quote = quote[top[quote] | (raw[quote - 1] != 0x20)]
    for letters in SHORT:
        if not len(quote):
            break
        k = len(letters)
        inside = quote[quote + k < n]
        for j, letter in enumerate(letters, 1):
            inside = inside[(raw[inside + j] == letter) & ~top[inside + j]]
        start[inside + 1] = False
        beyond = inside[inside + 1 + k < n] + 1 + k
        start[beyond] = True
        quote = np.setdiff1d(quote, inside, assume_unique=True)
    return np.flatnonzero(start)


class PieceEncoder:
    """Encodes columns of texts to flat id arrays."""

    def __init__(self, path: str, max_pieces: int = 500_000):
        self.special = [s.encode() for s in special_strings(path)]
        self.library = load(path)
        self.vocab_size = self.library.get_vocab_size(with_added_tokens=True)
        self.max_pieces = max_pieces
        self._newline = self.library.encode("\n", add_special_tokens=False).ids
        self._known: dict[bytes, int] = {}
        self._ids = np.empty(1 << 16, np.uint32)
        self._starts = np.empty(1 << 14, np.int64)
        self._lengths = np.empty(1 << 14, np.int64)
        self._again = np.zeros(1 << 14, bool)
        self._used = 0

    def _forget(self) -> None:
        """Drop the pieces that were met once only since the last time."""
        n = len(self._known)
        keep = np.flatnonzero(self._again[:n])
        if len(keep) > self.max_pieces // 2:
            keep = keep[:0]
        pieces = list(self._known)
        ids, lengths = self._gather(keep), self._lengths[keep].copy()
        self._known = {pieces[k]: j for j, k in enumerate(keep.tolist())}
        self._ids[:len(ids)] = ids
        self._used = len(ids)
        self._lengths[:len(keep)] = lengths
        self._starts[:len(keep)] = np.cumsum(lengths) - lengths
        self._again[:] = False

    def _library_ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of pieces, their ids in it, one after another, and how many
        each has. Pieces are handed over in lines, which the pattern parts again:
        but for white space, no piece holds or touches a line's end."""
        plain = np.array([not p.isspace() and b"\xc2\x85" not in p and b"\xc2\xa0" not in p for p in pieces], bool)
        at, odd = np.flatnonzero(plain), np.flatnonzero(~plain)
        lines = [pieces[k] for k in at.tolist()]
        step = 256
        chunks = [b"\n".join(lines[k:k + step]).decode() for k in range(0, len(lines), step)]
        parts = []
        for e in self.library.encode_batch_fast(chunks, add_special_tokens=False):
            parts += e.ids, self._newline
        ids = np.concatenate([np.array(p, np.uint32) for p in parts]) if parts else np.empty(0, np.uint32)
        cut = np.flatnonzero(ids == self._newline[0])
        lengths = np.diff(cut, prepend=-1) - 1
        if len(cut) != len(lines):
            raise AssertionError("the library parted lines in another way")
        ids = np.delete(ids, cut)
        if len(odd):
            found = self.library.encode_batch_fast([pieces[k].decode() for k in odd.tolist()], add_special_tokens=False)
            more = [np.array(e.ids, np.uint32) for e in found]
            ids, lengths = np.concatenate([ids, *more]), np.append(lengths, [len(m) for m in more])
        return np.concatenate([at, odd]), ids, lengths

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Keep the ids of new pieces; the numbers that these have from now on."""
        order, ids, lengths = self._library_ids(pieces)
        n, m = len(self._known), len(pieces)
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        while n + m > len(self._starts):
            self._starts, self._lengths = (np.concatenate([x, np.empty_like(x)]) for x in (self._starts, self._lengths))
            self._again = np.concatenate([self._again, np.zeros_like(self._again)])
        self._ids[self._used:self._used + len(ids)] = ids
        self._starts[n:n + m] = self._used + np.cumsum(lengths) - lengths
        self._lengths[n:n + m] = lengths
        self._used += len(ids)
        self._known.update(zip([pieces[k] for k in order.tolist()], range(n, n + m)))
        number = np.empty(m, np.int64)
        number[order] = np.arange(n, n + m)
        return number

    def _gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of known pieces, one after another."""
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._ids[np.arange(total) + np.repeat(self._starts[at] - (ends - lengths), lengths)]

    def _pieces(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and how many each text has."""
        starts = piece_starts(raw, ends)
        counts = np.diff(np.searchsorted(starts, ends), prepend=0)
        if not len(starts):
            return starts, counts
        offsets = np.append(starts, len(raw)).astype(np.int32)
        listed = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = listed.dictionary_encode()
        values = coded.dictionary.to_pylist()
        if len(self._known) > self.max_pieces:
            self._forget()
        number = np.fromiter(map(self._known.get, values, itertools.repeat(-1)), np.int64, len(values))
        self._again[number[number >= 0]] = True
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn([values[k] for k in new.tolist()])
        return number[coded.indices.to_numpy()], counts

    def _column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Octets without the texts that go to the library whole, the ends of
        the texts there, and which those are."""
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
        ends = offsets[1:] - offsets[0]
        places = np.flatnonzero(raw >= FIRST_UNKNOWN)
        octets = raw.tobytes() if self.special else b""
        for s in self.special:
            at = octets.find(s)
            while at >= 0:
                places = np.append(places, at)
                at = octets.find(s, at + 1)
        whole = np.zeros(len(ends), bool)
        whole[np.searchsorted(ends, places, side="right")] = True
        if whole.any():
            sizes = np.diff(ends, prepend=0)
            raw = raw[np.repeat(~whole, sizes)]
            ends = np.cumsum(np.where(whole, 0, sizes))
        return raw, ends, whole

    def counts(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        raw, ends, whole = self._column(texts)
        at, counts = self._pieces(raw, ends)
        n = _sums(self._lengths[at], counts)
        for k in np.flatnonzero(whole):
            n[k] = len(self.library.encode(texts[int(k)].as_py(), add_special_tokens=False).ids)
        return n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        raw, ends, whole = self._column(texts)
        at, counts = self._pieces(raw, ends)
        ids, n = self._gather(at), _sums(self._lengths[at], counts)
        if not whole.any():
            return ids, n
        parts, place = [], 0
        for k in range(len(n)):
            parts.append(ids[place:place + n[k]])
            place += n[k]
            if whole[k]:
                parts[-1] = np.array(self.library.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
                n[k] = len(parts[-1])
        return np.concatenate(parts), n


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` cut into runs of ``counts``."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@functools.lru_cache(maxsize=2)
def shared(path: str) -> PieceEncoder:
    """One encoder per Python worker, which serves many tasks."""
    return PieceEncoder(path)


def runs(texts: pa.Array, max_bytes: int = 1 << 22):
    """``(from, to)`` runs of rows of about ``max_bytes``: bounds the memory
    of a step by its longest text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for k, s in enumerate(sizes.tolist()):
        if size and size + s > max_bytes:
            yield start, k
            start, size = k, 0
        size += s
    if start < len(sizes):
        yield start, len(sizes)

