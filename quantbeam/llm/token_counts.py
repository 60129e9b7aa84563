"""Token counts of texts of any length, by overlap resynchronisation.

Short texts are encoded whole. A huge text is encoded in chunks that overlap;
neighbours are spliced where both see a piece of the split pattern begin.

Why such a place is exact. The library scans a text from left to right, and
what it finds from a place on where a piece begins depends on the text from
there on alone. So if the earlier chunk's boundary is one of the whole text,
and the later chunk has a boundary there too, the later chunk's pieces from
there on are those of the whole text. The earlier chunk's boundaries are right
by induction, but for those within ``MARGIN`` and a special string's length of
its end, where a longer match might have been cut off; they are not used.

Where the overlap has no common boundary (one endless word), it is doubled,
back to the last proven boundary if need be; from there the next chunk is
right by construction and reaches further than the last, so the loop ends.

Null and empty texts have no tokens. Each row is counted for itself, whatever
rows are repeated or share an id; an empty table gives an empty table. Columns other than the id and the text are not read, so their names cannot
clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quantbeam.llm import pieces
from quantbeam.llm.base import importable, pick

#: Characters that the split pattern looks ahead at most, and some.
MARGIN = 8

COUNTS = "doc_id long, n_bytes long, n_tokens long"


def boundaries(library, chunk: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Places where pieces begin, the tokens before each, and all tokens."""
    e = library.encode(chunk, add_special_tokens=False)
    piece = np.array(e.word_ids, np.int64)
    first = np.flatnonzero(np.diff(piece, prepend=-1)) if len(piece) else np.empty(0, np.int64)
    starts = np.array([a for a, _ in e.offsets], np.int64)[first]
    return starts, first, len(e.ids)


def count_long(library, text: str, margin: int, chunk: int, overlap: int) -> int:
    """Tokens of ``text``, holding the encoding of one chunk and the next."""
    total, proven = 0, 0          # tokens before the proven boundary, and where it is
    begin, end = 0, min(chunk, len(text))
    starts, before, n = boundaries(library, text[:end])
    tokens_at_proven = 0          # tokens of this chunk before the proven boundary
    while end < len(text):
        wide = overlap
        while True:
            follow = max(proven, end - wide)
            reach = min(len(text), max(end, follow) + chunk)
            starts2, before2, n2 = boundaries(library, text[follow:reach])
            # Places of the whole text, in both chunks; ``proven`` itself counts.
            mine = starts + begin
            usable = mine[(mine >= proven) & (mine <= end - margin)]
            common, _, at2 = np.intersect1d(usable, starts2 + follow, return_indices=True)
            if follow == proven and not len(common):
                common, at2 = np.array([proven]), np.array([0])
            if len(common):
                break
            wide *= 2
        place = int(common[-1])
        here = int(before[np.searchsorted(mine, place)])
        total += here - tokens_at_proven
        tokens_at_proven, proven = int(before2[at2[-1]]), place
        begin, end, starts, before, n = follow, reach, starts2, before2, n2
    return total + n - tokens_at_proven


def count_tokens(docs: DataFrame, tokenizer: str, chunk_chars: int = 1 << 15, overlap_chars: int = 1 << 10) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every text; texts over two chunks
    are counted chunk by chunk."""
    importable(docs.sparkSession)

    def count(batches):
        encoder = pieces.shared(tokenizer)
        margin = MARGIN + max(map(len, pieces.special_strings(tokenizer)), default=0)
        for batch in batches:
            texts = batch.column(1)
            size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            huge = size > 2 * chunk_chars
            n = np.zeros(len(texts), np.int64)
            for k in np.flatnonzero(huge).tolist():
                n[k] = count_long(encoder.library, texts[k].as_py(), margin, chunk_chars, overlap_chars)
            short = texts.filter(pa.array(~huge))
            place = np.flatnonzero(~huge)
            for a, b in pieces.runs(short):
                n[place[a:b]] = encoder.counts(short.slice(a, b - a))
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.record_batch({"doc_id": batch.column(0), "n_bytes": n_bytes,
                                   "n_tokens": pa.array(n)})

    return pick(docs).mapInArrow(count, COUNTS)
