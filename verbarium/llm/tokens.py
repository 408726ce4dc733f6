"""Counting text in tokens of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: Default rank file; every operator takes another as a parameter.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that goes with the rank file; it splits text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str = RANKS):
    """The tokenizer of a rank file; loaded once in each Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})




def encode(enc, text: str) -> list[int]:
    """Token ids of a text of any length; lone surrogates are encoded as replacement characters."""
    try:
        return enc.encode_ordinary(text)
    except UnicodeEncodeError:
        return enc.encode_ordinary(text.encode("utf-16", "surrogatepass").decode("utf-16", "replace"))


@lru_cache(maxsize=2)
def _widths(enc) -> tuple[np.ndarray, np.ndarray]:
    """Per token: the characters that start in it, and whether it starts inside one."""
    n = enc.n_vocab
    starts, inside = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        try:
            b = enc.decode_single_token_bytes(i)
        except KeyError:
            continue
        starts[i] = sum(not 0x80 <= x < 0xC0 for x in b)
        inside[i] = 0x80 <= b[0] < 0xC0
    return starts, inside


def places(enc, ids: list[int]) -> list[int]:
    """For each token the place of the character it starts with or in."""
    starts, inside = _widths(enc)
    at = np.asarray(ids, np.int64)
    width = starts[at]
    return (np.cumsum(width) - width - inside[at]).tolist()
