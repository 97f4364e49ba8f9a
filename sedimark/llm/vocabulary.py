"""Vocabulary files of public tokenizers."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

FOLDER = "/opt/tokenizers"

# Fixed value: the pattern that splits text before the merges of byte_bpe_50k.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens by their bytes, from a rank file: a base64 token and its rank on each line."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks
