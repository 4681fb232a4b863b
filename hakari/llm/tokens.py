"""Sizes in tokens of a public byte-pair vocabulary."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: Folder with the vocabulary files and the file that is used; both may be set by the environment.
FOLDER = os.environ.get("HAKARI_TOKENIZERS", "/opt/tokenizers")
FILE = os.environ.get("HAKARI_TOKENIZER", "byte_bpe_multi_50k.tiktoken")
#: The public split pattern of this vocabulary family (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(4)
def widths(path: str) -> np.ndarray:
    """Bytes of each token."""
    enc = encoding(path)
    out = np.zeros(enc.n_vocab + 1, np.int32)
    for i in range(enc.n_vocab):
        try:
            out[i] = len(enc.decode_single_token_bytes(i))
        except KeyError:
            pass
    return out


def default_path() -> str:
    return os.path.join(FOLDER, FILE)
