"""Exact BPE ids of whole texts, one dynamic-programming step per prefix, and back.

The library's file says how a text is parted into pieces. The ids of a piece
are found without a queue of merges:

- A sequence of tokens is what the merges leave of its symbols if and only if
  this holds for each pair of neighbours in it. So every prefix of a piece has
  one last token: a token that ends there and is compatible with the last token
  of the prefix before it. It is stored for each prefix; following these back
  from the end gives the ids.
- Tokens that end at a place are read from a suffix automaton of the vocabulary:
  its state is the longest run of symbols before the place that stands in some
  token, and tokens that are suffixes of it lie along its suffix links.
- Two tokens are compatible if no merge across their boundary would have come
  before the merges that made them. Going back in time, each undoes its last
  merge at the boundary, and every pair that ever met there is looked up.

The time is linear in the piece's length but for the tokens that end at one
place (an endless word costs what many short words do).

Null and empty texts have no ids. Texts of any length are encoded whole, batch
by batch, each beside the memory for its own ids; pieces of up to ``LONG``
characters are remembered, ``max_pieces`` of them at most. Each row is encoded for
itself, whatever rows are repeated or share an id; an empty table gives an
empty table. Columns other than the id and the text are not read, so their names
cannot clash.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick

# How files of the known kind normalise and part texts.
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters that every version of Unicode classes and lower-cases alike.
OTHER = regex.compile(r"[^\x00-ſ]|İ")
#: Characters of the longest piece that is remembered.
LONG = 48


def _of_class(pattern: str) -> str:
    """The known characters of a class, escaped."""
    return "".join(re.escape(chr(c)) for c in range(0x180) if regex.match(pattern, chr(c)))


def _known_split():
    """``KNOWN_PATTERN`` for known characters, its classes listed: faster."""
    pattern = KNOWN_PATTERN.replace(r"\s\p{L}\p{N}", _of_class(r"[\s\p{L}\p{N}]"))
    return re.compile(pattern.replace(r"\p{L}", _of_class(r"\p{L}")).replace(r"\p{N}", _of_class(r"\p{N}"))).findall


split_known = _known_split()

ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_characters() -> list[str]:
    """The character that stands for each byte in files of byte-level BPE:
    printable ones for themselves, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = itertools.count(0x100)
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class SuffixAutomaton:
    """All substrings of the given strings of symbols: ``step[state]`` by
    symbol, suffix links, and the length of each state's longest string."""

    def __init__(self, strings):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        #: ``ends[state]``: (length, number) of the strings that are in the state.
        self.ends: dict[int, list[tuple[int, int]]] = {}
        at_end = []
        for number, string in strings:
            state = 0
            for symbol in string:
                state = self._extend(state, symbol)
            at_end.append((number, string))
        for number, string in at_end:          # states are split until all are in
            state = 0
            for symbol in string:
                state = self.step[state][symbol]
            self.ends.setdefault(state, []).append((len(string), number))

    def _new(self, size: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state of the strings of ``q`` no longer than ``p``'s and ``symbol``."""
        part = self._new(self.size[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = part
        while p >= 0 and self.step[p].get(symbol) == q:
            self.step[p][symbol] = part
            p = self.link[p]
        return part

    def _extend(self, last: int, symbol: int) -> int:
        q = self.step[last].get(symbol)
        if q is not None:                      # the string is in already
            return q if self.size[q] == self.size[last] + 1 else self._split(last, symbol, q)
        new, p = self._new(self.size[last] + 1, {}, 0), last
        while p >= 0 and symbol not in self.step[p]:
            self.step[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][symbol]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, symbol, q)
        return new


class Bpe:
    """The merges of a file, and the ids of pieces by them."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or any(model.get(k) for k in (
                "dropout", "byte_fallback", "continuing_subword_prefix", "ignore_merges")):
            raise ValueError("not a plain file of BPE merges")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        shown = byte_characters()
        #: Symbol of each byte inside a piece, and at its end.
        self.inner = [vocab[c] for c in shown]
        self.final = [vocab[c + suffix] for c in shown]
        never = len(model["merges"])
        self.rank = {s: -1 for s in (*self.inner, *self.final)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, token = vocab[a], vocab[b], vocab[a + b]
            if token in self.rank or left not in self.rank or right not in self.rank:
                raise ValueError(f"merge {rank}: tokens must be made once, of earlier ones")
            self.rank[token], self.parts[token], self.merged[left, right] = rank, (left, right), rank
        # Tokens that the merges of their own symbols end in.
        proper, symbols = set(self.rank) - set(self.parts), {s: (s,) for s in self.rank}
        for token, (left, right) in self.parts.items():
            symbols[token] = symbols[left] + symbols[right]
            if left in proper and right in proper and self._apart(left, right, self.rank[token]):
                proper.add(token)
        self.automaton = SuffixAutomaton((t, symbols[t]) for t in sorted(proper))
        self._never = never
        self._suffixes: dict[int, tuple[tuple[int, int], ...]] = {}
        self._pairs: dict[int, bool] = {}
        # Of the last piece but its last symbol: the automaton's state and length
        # after each prefix, and each prefix's last token and its symbols.
        self._inner, self._states, self._held, self._last, self._width = b"", [0], [0], [], []

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether no merge across the boundary comes before those that make
        the two tokens, and before ``until``. Of two equal merges that overlap
        the left one comes first."""
        rank, parts, merged = self.rank, self.parts, self.merged
        left_until = right_until = until
        while True:
            met = merged.get((left, right), until)
            if met < left_until and met <= right_until and met < until:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                left_until, left = rank[left], parts[left][1]
            else:
                right_until, right = rank[right], parts[right][0]

    def _tokens(self, state: int) -> tuple[tuple[int, int], ...]:
        """``(length, token)`` of all suffixes of the state's strings that are
        tokens, longest first."""
        found = self._suffixes.get(state)
        if found is None:
            rest = self._tokens(self.automaton.link[state]) if state else ()
            found = self._suffixes[state] = (*sorted(self.automaton.ends.get(state, ()), reverse=True), *rest)
        return found

    def ids(self, piece: bytes) -> np.ndarray:
        """The ids of one piece. What was found for the prefixes that it
        shares with the piece before is used again: ask in sorted order."""
        if not piece:
            return np.empty(0, np.uint32)
        states, held, last, width = self._states, self._held, self._last, self._width
        same = 0
        for a, b in zip(piece[:-1], self._inner):
            if a != b:
                break
            same += 1
        del states[same + 1:], held[same + 1:], last[same:], width[same:]
        self._inner = piece[:-1]
        symbols = [self.inner[b] for b in piece[same:]]
        symbols[-1] = self.final[piece[-1]]
        step, link, size = self.automaton.step, self.automaton.link, self.automaton.size
        suffixes, pairs = self._suffixes, self._pairs
        state, run = states[-1], held[-1]
        for at, symbol in enumerate(symbols, same):
            while symbol not in step[state]:   # every symbol is a token: the start has it
                state = link[state]
                run = size[state]
            state = step[state][symbol]
            run += 1
            for length, token in suffixes.get(state) or self._tokens(state):
                if length > run:
                    continue
                if length > at:
                    break
                key = last[at - length] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= 1 << 20:
                        pairs.clear()
                    fits = pairs[key] = self._apart(last[at - length], token, self._never)
                if fits:
                    break
            else:
                raise AssertionError("a prefix without a last token")
            states.append(state)
            held.append(run)
            last.append(token)
            width.append(length)
        found, at = [], len(last) - 1
        while at >= 0:
            found.append(last[at])
            at -= width[at]
        for stack in (states, held, last, width):   # the last symbol stands at ends alone
            stack.pop()
        return np.array(found[::-1], np.uint32)


class Codec:
    """Encoder and decoder of one file."""

    def __init__(self, path: str, max_pieces: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        stages = split.get("pretokenizers", [split])
        if stages[-1].get("type") != "ByteLevel" or stages[-1].get("add_prefix_space") or spec.get("post_processor"):
            raise ValueError(f"{path}: not byte-level BPE")
        added = spec.get("added_tokens") or []
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError(f"{path}: added tokens that depend on their surroundings")
        self.added = {a["content"]: a["id"] for a in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.library = pieces.load(path)
        self.bpe, self.max_pieces = Bpe(spec["model"]), max_pieces
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._known_kind = spec.get("normalizer") == KNOWN_NORMALIZER and len(stages) == 2 and stages[0] == {
            "type": "Split", "pattern": {"Regex": KNOWN_PATTERN}, "behavior": "Removed", "invert": True} \
            and not stages[1]["use_regex"]
        self._octet = {c: b for b, c in enumerate(byte_characters())}

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without added tokens."""
        if self._known_kind and (text.isascii() or not OTHER.search(text)):
            return split_known(text.lower())
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [bytes(map(self._octet.__getitem__, p)).decode()
                for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _ids(self, found: list[str]) -> bytes:
        """The ids of pieces. Two generations of pieces are remembered: what
        the older one alone has and nobody asks for is dropped with it."""
        try:
            return b"".join(map(self._young.__getitem__, found))
        except KeyError:
            pass
        if len(self._young) >= self.max_pieces // 2:
            self._young, self._old = {}, self._young
        young, old = self._young, self._old
        missing = {piece for piece in found if piece not in young}
        for piece in sorted(missing):
            ids = old.get(piece)
            young[piece] = self.bpe.ids(piece.encode()).astype("<u4").tobytes() if ids is None else ids
        ids = b"".join(map(young.__getitem__, found))
        for piece in missing:
            if len(piece) > LONG:
                del young[piece]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not (self._cut and self._cut.search(text)):
            return self._ids(self.pieces(text))
        # Every second part is an added token.
        return b"".join(self.added[part].to_bytes(4, "little") if k % 2 else self._ids(self.pieces(part))
                        for k, part in enumerate(self._cut.split(text)))


@functools.lru_cache(maxsize=2)
def shared(path: str) -> Codec:
    """One codec per Python worker, which serves many tasks."""
    return Codec(path)


@functools.lru_cache(maxsize=2)
def token_strings(path: str) -> list[str | None]:
    """The tokens by id; None where an id has none."""
    vocab = pieces.load(path).get_vocab(with_added_tokens=True)
    found: list[str | None] = [None] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        found[i] = token
    return found


def decode_ids(path: str, ids: np.ndarray) -> str:
    """The text of ids, special tokens included: the file's decoder, or
    without one the tokens with a space between. Unknown ids have no text."""
    decoder, strings = pieces.load(path).decoder, token_strings(path)
    tokens = list(map(strings.__getitem__, ids[ids < len(strings)].tolist()))
    if None in tokens:
        tokens = [t for t in tokens if t is not None]
    return decoder.decode(tokens) if decoder is not None else " ".join(tokens)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every text; ids are little-endian
    unsigned 32-bit integers."""
    importable(docs.sparkSession)

    def run(batches):
        codec = shared(tokenizer)
        for batch in batches:
            for a, b in pieces.runs(batch.column(1)):
                rows = batch.slice(a, b - a)
                ids = [codec.encode(t) if t else b"" for t in rows.column(1).to_pylist()]
                yield pa.record_batch({"doc_id": rows.column(0), "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                                       "ids": pa.array(ids, pa.binary())})

    return pick(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of ``encode`` with the text of their ids; null ids have the
    empty text."""
    importable(encoded.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b in pieces.runs(batch.column(2)):
                rows = batch.slice(a, b - a)
                texts = [decode_ids(tokenizer, np.frombuffer(i or b"", "<u4")) for i in rows.column(2).to_pylist()]
                yield pa.record_batch([*rows.columns, pa.array(texts, pa.string())],
                                      names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
