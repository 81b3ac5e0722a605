"""Token counts of whole texts, with long documents encoded in overlapping chunks.

A byte-level encoder first cuts a text into words, left to right and without
looking back, and merges bytes inside a word only. Hence two encodings of
overlapping stretches agree from any place on at which both begin a word, up
to the last words of the earlier stretch, whose ends it does not see. A blank
behind a character that is none always begins a word, in every script: no word
goes on over a blank, and no run of blanks holds the character before it. So
does a full stop or comma of Chinese or Japanese behind a sign of these
scripts. Such a place is a proven splice.

A chunk ends behind the last splice in reach of its end; the next one begins
some characters before it, so that both hold the place, and must show a token
that starts there. If there is no splice near the end the search goes further
back, and where a chunk has none at all, it grows until the next splice: a word
that long cannot be cut. No stretch is encoded anew but for the overlaps.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of
from shopmart.llm.tokens import VOCABULARY, Encoder, encoder

CHUNK_CHARS = 1 << 14
OVERLAP_CHARS = 1 << 8
LIMIT = 1024

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


# Blanks by all versions of Unicode; \S leaves out all of them and some more.
_SPLICE = re.compile(
    "(?<=\\S)[\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    "|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5])[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f]"
)


def _last_splice(text: str, low: int, high: int, reach: int) -> int | None:
    """The last splice in low..high; looked for from the end in growing stretches."""
    edge = high
    while edge > low:
        begin = max(low, high - reach)
        found = None
        for found in _SPLICE.finditer(text, begin, edge):
            pass
        if found:
            return found.start()
        edge, reach = begin, reach * 2
    return None


def _tokens_before(enc: Encoder, ids: list[int], n_bytes: int) -> int | None:
    """How many tokens fill the first bytes; none if a token runs across."""
    ends = np.cumsum(enc.byte_lengths[ids]) if ids else np.zeros(0, np.int64)
    at = int(np.searchsorted(ends, n_bytes)) + 1 if n_bytes else 0
    return at if not n_bytes or (at <= len(ends) and ends[at - 1] == n_bytes) else None


def encode_spliced(text: str, enc: Encoder, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Ids of the whole text; no encoder call gets more than a chunk and an overlap, save words that are longer."""
    out: list[int] = []
    done = 0  # characters whose ids are out; 0 or a splice
    while done < len(text):
        end = min(len(text), done + chunk)
        splice = None
        if end < len(text):
            splice = _last_splice(text, done + 1, end, overlap)
            if splice is None:
                following = _SPLICE.search(text, end)
                splice = following.start() if following else None
            # Some characters behind the splice are encoded, too, and left to the next chunk.
            end = len(text) if splice is None else min(len(text), max(end, splice + overlap))
        reach = overlap
        while True:
            begin = max(0, done - reach) if done else 0
            ids = enc.ids(text[begin:end])
            first = _tokens_before(enc, ids, len(text[begin:done].encode()))
            last = len(ids) if splice is None else _tokens_before(enc, ids, len(text[begin:splice].encode()))
            if first is not None and last is not None:
                break
            if begin == 0:
                return enc.ids(text)  # cannot happen at a proven splice
            reach *= 2
        out += ids[first:last]
        done = len(text) if splice is None else splice
    return out


def count_tokens(
    docs: DataFrame,
    limit: int = LIMIT,
    vocabulary: str = VOCABULARY,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty: no bytes, no tokens. Repeated rows and ids,
    also null ids, are counted row by row; an empty table gives an empty one.
    """

    def work(rows: Batches) -> Batches:
        enc = encoder(vocabulary)
        for full in rows:
            for part in slices(full):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n_tokens = [len(encode_spliced(t, enc, chunk, overlap)) for t in texts]
                yield batch(
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                    [part.column("doc_id"), [len(t.encode()) for t in texts], n_tokens, [n > limit for n in n_tokens]],
                    [pa.int64(), pa.int64(), pa.int64(), pa.bool_()],
                )

    return map_rows(texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long")), work, COUNTS)
