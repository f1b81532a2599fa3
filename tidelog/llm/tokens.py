"""Token ids of whole texts under a byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from array import array

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer


class ByteBpe:
    """Ids as little-endian unsigned 32-bit bytes, equal to those of ``name``.json in the library ``tokenizers``."""

    def __init__(self, name: str = "byte_bpe_50k"):
        self.name = name
        lines = open(public_tokenizers.path(f"{name}.tiktoken"), "rb")
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            ids = self.encoding.encode_ordinary(text)
        except BaseException as error:  # the pattern library gives up on extremely long runs of white space
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            slow = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
            slow.encode_special_tokens = True
            ids = slow.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()
