"""Words of whole Arrow text columns as numpy arrays: starts, lengths, 64-bit hashes.

No Python step per word: the bytes of a portion of texts are classed by a
table of 256 entries, word borders are found by comparing neighbours, and
words are hashed eight bytes at a time.  Memory follows the portion, some ten
times its bytes; a portion is at most ``PORTION_BYTES`` or one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

PORTION_BYTES = 2_000_000
#: Words beyond so many bytes are hashed one by one.
LONG_WORD = 512

_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def byte_table(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(mapped byte, is a word's byte) for each byte; ``lower`` maps A-Z to a-z."""
    mapped = np.arange(256, dtype=np.uint8)
    if lower:
        mapped[65:91] += 32
    word = np.ones(256, bool)
    word[list(separators)] = False
    return mapped, word


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of texts ``first`` to ``first + len(bounds) - 1`` of a column.

    ``bounds`` holds each text's first word and, at the end, the number of
    words; ``data`` the mapped bytes, with eight zeros behind.
    """

    first: int
    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.bounds))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """One 64-bit hash a word; words of up to eight bytes never share one with words of their length."""
        data, starts, lengths = self.data, self.starts, self.lengths
        h = mixed(self._eight(data, starts, lengths) + _GOLD * (lengths.astype(np.uint64) + np.uint64(seed)))
        at = 8
        rest = np.flatnonzero(lengths > at)
        while len(rest) and at < LONG_WORD:
            h[rest] = mixed(h[rest] * _GOLD ^ self._eight(data, starts[rest] + at, lengths[rest] - at))
            at += 8
            rest = rest[lengths[rest] > at]
        for i in rest.tolist():
            h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes(), seed + 1)
        return h

    @staticmethod
    def _eight(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        # every eight neighbouring bytes as one number
        raw = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[starts]
        return raw & _MASK[np.minimum(lengths, 8)]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()


def portions(texts: pa.Array, table: tuple[np.ndarray, np.ndarray], most: int = PORTION_BYTES) -> Iterator[Words]:
    """The words of a column of strings or UTF-8 bytes, portion by portion; a null has none."""
    if not len(texts):
        return
    column = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    mapped, is_word = table
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        cut = offsets[at : end + 1] - offsets[at]
        own = np.zeros(int(cut[-1]) + 8, np.uint8)
        own[: cut[-1]] = mapped[data[offsets[at] : offsets[end]]]
        inside = is_word[own]
        inside[cut[-1] :] = False
        begin, last = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        # neighbouring texts share no separator
        borders = cut[:-1][cut[1:] > cut[:-1]]
        begin[borders] = inside[borders]
        borders = borders[borders > 0] - 1
        last[borders] = inside[borders]
        starts = np.flatnonzero(begin)
        lengths = np.flatnonzero(last) + 1 - starts
        yield Words(at, own, starts, lengths, np.searchsorted(starts, cut))
        at = end


def binary_of(words: Words, at: np.ndarray) -> pa.Array:
    """The words with numbers ``at`` as a binary column."""
    k = words.lengths[at]
    ends = np.cumsum(k)
    data = words.data[np.repeat(words.starts[at] - ends + k, k) + np.arange(k.sum())]
    offsets = np.concatenate((np.zeros(1, np.int64), ends))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value, place of each number's first one), numbered as they are met."""
    which = pa.array(values).dictionary_encode().indices.to_numpy()
    first = np.zeros(int(which.max(initial=-1)) + 1, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return which, first


class Lookup:
    """Finds given words (distinct, as the table maps them) among the words of a portion, exactly.

    Hashes are sorted and reached by their first bits; words of more than eight
    bytes are compared, shorter ones are told apart by hash and length.
    """

    def __init__(self, given: list[bytes], table: tuple[np.ndarray, np.ndarray]):
        self.words = next(portions(pa.array([b" ".join(given)], pa.large_binary()), table, 1 << 62))
        self.seed = 0
        while len(np.unique(h := self.words.hashes(self.seed))) < len(h):  # two of them share a hash
            self.seed += 1
        order = np.argsort(h)
        self.hashes, self.order = h[order], order.astype(np.int32)
        bits = min(22, len(h).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        own = np.bincount((self.hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.concatenate((np.zeros(1, np.int32), np.cumsum(own).astype(np.int32)))

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(the number of the given word or -1, the hash) of each word."""
        h = words.hashes(self.seed)
        out = np.full(len(h), -1, np.int64)
        if not len(self.hashes):
            return np.full(len(h), -1, np.int64), h
        first = (h >> self.shift).astype(np.int64)
        at, end = self.first[:-1].take(first, mode="clip"), self.first[1:].take(first, mode="clip")
        same = self.hashes.take(at, mode="clip") == h
        same &= at < end
        out = np.where(same, self.order.take(at, mode="clip"), -1).astype(np.int64)
        at += 1
        live = np.flatnonzero(~same & (at < end))
        while len(live):
            same = self.hashes[at[live]] == h[live]
            out[live[same]] = self.order[at[live[same]]]
            live = live[~same]
            at[live] += 1
            live = live[at[live] < end[live]]
        found = np.flatnonzero(out >= 0)
        number = out[found]
        k = words.lengths[found]
        same = k == self.words.lengths[number]
        rest, step = np.flatnonzero(same & (k > 8)), 0
        while len(rest) and step < LONG_WORD:
            left, mine, given = k[rest] - step, words.starts[found[rest]] + step, self.words.starts[number[rest]] + step
            equal = words._eight(words.data, mine, left) == words._eight(self.words.data, given, left)
            same[rest[~equal]] = False
            step += 8
            rest = rest[equal & (left > 8)]
        for i in rest.tolist():
            same[i] = words.word(found[i]) == self.words.word(number[i])
        out[found[~same]] = -1
        return out, h


class Rolling:
    """Hashes of any run of words of a portion, from one running sum.

    A run's hash is the polynomial of its words' hashes, taken modulo 2^64.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, hashes: np.ndarray, base: int):
        self.n = len(hashes)
        up, self.down = self.powers(base, self.n + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[: self.n], dtype=np.uint64)))

    @classmethod
    def powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """base^i and base^-i for i < n, kept per worker."""
        if base not in cls._powers or len(cls._powers[base][0]) < n:
            size = 1 << max(10, int(n - 1).bit_length())
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps, dtype=np.uint64))
            cls._powers[base] = (both[0], both[1])
        up, down = cls._powers[base]
        return up[:n], down[:n]

    def of(self, starts: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.down[starts])
