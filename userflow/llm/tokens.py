"""Token ids of whole texts, by the vocabulary files of a public tokenizer."""

from __future__ import annotations

import base64
import os
from functools import lru_cache
from typing import NamedTuple

import numpy as np

# Fixed value: how a byte-level BPE of this family cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Vocabulary(NamedTuple):
    """``file`` is read by the tokenizers library. ``ranks``, if given, holds the same
    vocabulary as ranks, for an encoder that gives the same ids several times faster."""

    file: str
    ranks: str | None = None


def public(name: str = "byte_bpe_50k") -> Vocabulary:
    """A vocabulary of the installed public tokenizers."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"))


class Encoder:
    """Ids of a text as the tokenizers library gives them, without added tokens around."""

    def __init__(self, vocabulary: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary.file)
        self.special = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.fast = None
        if vocabulary.ranks:
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                pairs = [line.split() for line in lines]
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is None or any(token in text for token in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder for each worker."""
    return Encoder(vocabulary)
