from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from fundscope.llm.bytewords import Lookup, Rolling, binary_of, byte_table, portions

BLANKS = byte_table(b" \t\n\x0b\f\r", lower=True)


def test_words_are_those_of_split():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aB é\n\t漢 x") for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += [None, "", "tail", " ", "next", "y" * 3000 + " " + "Y" * 3000, "z" * 9]
    column = pa.chunked_array([pa.array(texts)]).combine_chunks().slice(3)
    for most in (1, 50, 10**6):
        got, hashes = [], {}
        for part in portions(column, BLANKS, most):
            assert part.first == len(got)
            h = part.hashes().tolist()
            for a, b in zip(part.bounds[:-1], part.bounds[1:]):
                got.append([part.word(i) for i in range(a, b)])
                for i in range(a, b):
                    assert hashes.setdefault(part.word(i), h[i]) == h[i]
        lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
        assert got == [(t or "").encode().translate(lower).split() for t in texts[3:]]
        assert len(set(hashes.values())) == len(hashes)
    assert list(portions(pa.array([], pa.string()), BLANKS)) == []


def test_runs_hash_by_content():
    h = np.random.default_rng(1).integers(0, 2**63, 50).astype(np.uint64)
    run = Rolling(np.concatenate((h, h[::-1], h)), 0xD1342543DE82EF95)
    assert run.of(np.array([3]), 20) == run.of(np.array([103]), 20)
    assert run.of(np.array([3]), 20) != run.of(np.array([53]), 20)
    assert run.of(np.array([3]), 20) != run.of(np.array([3]), 21)


def test_lookup_is_exact(monkeypatch):
    given = [b"abcdefghijkl", b"abcdefghijkm", b"ab", "é".encode()]
    text = next(portions(pa.array(["abcdefghijkl ABCDEFGHIJKX ab ac abcdefghijkm é"]), BLANKS))
    known = Lookup(given, BLANKS)
    assert known.find(text)[0].tolist() == [0, -1, 2, -1, 1, 3]
    # a word that shares another's hash is not taken for it
    wrong = text.hashes(known.seed)
    wrong[1] = wrong[0]
    wrong[3] = wrong[0]
    monkeypatch.setattr(text, "hashes", lambda seed: wrong, raising=False)
    assert known.find(text)[0].tolist() == [0, -1, 2, -1, 1, 3]
    assert Lookup([], BLANKS).find(text)[0].tolist() == [-1] * 6
    assert binary_of(text, np.array([4, 0, 4, 5])).to_pylist() == [b"abcdefghijkm", b"abcdefghijkl", b"abcdefghijkm", "é".encode()]
    assert binary_of(text, np.zeros(0, np.int64)).to_pylist() == []


def test_lookup_among_many():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdef", k=rng.randrange(1, 14))).encode() for _ in range(5000)})
    given = words[::2]
    rng.shuffle(given)
    asked = rng.choices(words, k=20_000)
    text = next(portions(pa.array([b" ".join(asked)], pa.binary()), BLANKS, 1 << 40))
    number = {w: i for i, w in enumerate(given)}
    assert Lookup(given, BLANKS).find(text)[0].tolist() == [number.get(w, -1) for w in asked]


def test_long_words_are_found_exactly(monkeypatch):
    """Under one hash for all, the bytes alone tell words of more than eight bytes apart."""
    long = b"x" * 600
    given = [b"abcdefghij", b"abcdefghijklmnopq", long]
    known = Lookup(given, BLANKS)
    asked = [b"abcdefghix", b"abcdefghijklmnopq", b"abcdefghijklmnopx", long, long[:-1] + b"y", b"abcdefghij"]
    text = next(portions(pa.array([b" ".join(asked)]), BLANKS))
    by_length = {len(w): h for w, h in zip(given, known.words.hashes())}
    monkeypatch.setattr(type(text), "hashes", lambda self, seed=0: np.array([by_length[n] for n in self.lengths.tolist()], np.uint64))
    assert known.find(text)[0].tolist() == [-1, 1, -1, 2, -1, 0]
