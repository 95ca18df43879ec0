"""Token ids by a public byte-level BPE rank file (the library does the work)."""

from __future__ import annotations

import base64

import numpy as np
import tiktoken

#: Fixed value: the pre-tokeniser pattern that belongs to the byte-level BPE rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """``ranks`` is the content of a rank file.  Ids end with ``end``, the first free id."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.enc = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.end = max(table.values()) + 1
        self.dtype = np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text and ``end``; null counts as empty."""
        ids = self.enc.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.uint32)
        return np.append(ids, self.end).astype(self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        return self.enc.decode_bytes([int(x) for x in ids]).decode("utf-8", "replace")
