"""Encoding with the public byte-level vocabulary, the same ids in less time.

`tokenizers` defines the ids. `tiktoken` reads the same merges several times
faster, but its pattern may class rare characters by another version of
Unicode. Texts below U+0250, whose classes no version has changed, go to the
fast encoder; all others go to `tokenizers` itself.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k"
END_ID = 50256
# Fixed value: the special string of the vocabulary file.
END_TEXT = "<|endoftext|>"

_UNSETTLED = re.compile("[^\x00-ɏ]")


class Encoder:
    """Ids and counts as the library for `<name>.json` gives them, special strings included."""

    def __init__(self, name: str = VOCABULARY) -> None:
        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_TEXT: END_ID}
        )
        self.byte_lengths = np.zeros(max(ranks.values()) + 2, dtype=np.int64)
        for token, rank in ranks.items():
            self.byte_lengths[rank] = len(token)
        self.byte_lengths[END_ID] = len(END_TEXT)

    def ids(self, text: str) -> list[int]:
        if _UNSETTLED.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        if END_TEXT in text:
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(name)
