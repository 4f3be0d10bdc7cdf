"""Token ids for packing: the rank file of the same vocabulary, an order of magnitude faster than its JSON form.

The ids equal those of the JSON vocabulary, which a test compares text by text.
"""

from __future__ import annotations

import base64

import numpy as np

RANKS, END = "byte_bpe_50k.tiktoken", "<|endoftext|>"
_loaded: dict[str, object] = {}


def encoder(ranks: str | None = None):
    """The encoder, loaded once in a process; the public rank file unless a path is given."""
    import public_tokenizers
    path = ranks or public_tokenizers.path(RANKS)
    if path not in _loaded:
        import tiktoken
        with open(path, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={END: len(table)})
    return _loaded[path]


def token_ids(text: str, ranks: str | None = None, end_id: int = 0) -> np.ndarray:
    """Ids of a whole text, then ``end_id``."""
    ids = encoder(ranks).encode_to_numpy(text, allowed_special="all")
    return np.append(ids.astype("<u4", copy=False), np.array([end_id], "<u4"))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but for a first that takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]
