"""Ids of the public byte-level BPE vocabulary, per Python worker.

The rank file of the vocabulary is read with tiktoken, which gives the same ids as
the ``tokenizers`` file about four times as fast (a test compares the two).
"""

from __future__ import annotations

import base64
import os
from array import array

#: Where the vocabulary files are; None: the installed package of public tokenizers.
TOKENIZER_DIR: str | None = None
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary(name: str, folder: str | None = None) -> str:
    folder = folder or TOKENIZER_DIR
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, folder: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary("byte_bpe_50k.tiktoken", folder), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = public_tokenizers.PATTERN
        self._bpe = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(self, text: str) -> list[int]:
        if "<|endoftext|>" in text:
            return self._bpe.encode(text, allowed_special="all")
        return self._bpe.encode_ordinary(text)

    def count(self, text: str) -> int:
        """Tokens of ordinary text."""
        return len(self._bpe.encode_ordinary(text))

    def packed(self, text: str) -> bytes:
        """The ids as unsigned 32-bit numbers, low byte first."""
        return array("I", self.ids(text)).tobytes()


_encoders: dict[str | None, Encoder] = {}


def encoder(folder: str | None = None) -> Encoder:
    """One per Python worker."""
    if folder not in _encoders:
        _encoders[folder] = Encoder(folder)
    return _encoders[folder]
