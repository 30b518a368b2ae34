"""Byte-pair encoders from public vocabulary files in tiktoken's format; the path is a parameter."""

from __future__ import annotations

import base64
from functools import cache

import tiktoken

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the split pattern these vocabularies were made with.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
