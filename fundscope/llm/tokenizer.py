"""Token ids of texts, with a public byte-level BPE vocabulary.

The vocabulary file is a parameter; it is read where tasks run, by the same
path, and is never part of this package.  Id ``separator`` (one past the last
rank) ends a document.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The pattern that the vocabulary's own tokenizer splits text with (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks of text whose ids a worker remembers.
CACHED_CHUNKS = 150_000
#: Longer chunks are encoded but not remembered.
CACHED_CHARS = 64

#: A space between two characters that are no white space always starts a piece of PATTERN.
_BREAK = re.compile(r"(?<=\S)(?= \S)")
_UNSAFE = re.compile(r"\s\s")


class Tokenizer:
    """Encodes texts chunk by chunk; equal chunks are encoded once per worker.

    Chunks are cut only before a space that stands between two non-blank
    characters, where the pattern starts a new piece anyway, so the ids are
    those of the whole text.
    """

    def __init__(self, path: str = VOCABULARY):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.separator = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if self.separator < 1 << 16 else "<u4")
        self._known: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        ids = self._known.get(chunk)
        if ids is None:
            ids = np.array(self.encoding.encode_ordinary(chunk), self.dtype).tobytes()
            if len(chunk) <= CACHED_CHARS:
                if len(self._known) >= CACHED_CHUNKS:
                    self._known.clear()
                self._known[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian bytes of ``dtype``; nothing for a null text."""
        if not text:
            return b""
        if _UNSAFE.search(text):
            chunks = _BREAK.split(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first] if first else []
            chunks += [" " + c for c in rest]
        known = self._known
        return b"".join([known.get(c) or self._chunk(c) for c in chunks])

    def decode(self, ids: bytes) -> str:
        return self.encoding.decode(np.frombuffer(ids, self.dtype).tolist())


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str = VOCABULARY) -> Tokenizer:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]
