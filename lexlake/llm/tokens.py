"""A public tokenizer, read once on the driver and carried to the tasks with the function."""

from __future__ import annotations

import base64
from functools import lru_cache

#: Where the vocabularies lie; every operator takes another path as a parameter.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pre-tokenizer pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str = TOKENIZER) -> bytes:
    """The vocabulary file; the driver reads it, so tasks need no such file."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoder(data: bytes):
    """The tokenizer of a vocabulary file's bytes, one for each worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("lexlake", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
