"""Public byte-level BPE vocabularies, loaded once a Python worker."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Fixed value: the public pre-tokenizer pattern that belongs to these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def ranks(path: str = DEFAULT) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoding(path: str = DEFAULT):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def byte_lengths(path: str = DEFAULT) -> np.ndarray:
    """Bytes of each token id."""
    out = np.zeros(max(ranks(path).values()) + 1, np.int64)
    for token, rank in ranks(path).items():
        out[rank] = len(token)
    return out


def encode(text: str, path: str = DEFAULT) -> np.ndarray:
    """Token ids of one whole text; control strings in it are ordinary text."""
    return np.array(encoding(path).encode_ordinary(text), np.uint32)
