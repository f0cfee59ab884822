from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundscope.llm import collocation

PIECE = re.compile(r"[.,;:!?\n-\r]")


def brute(rows, least, top):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        own = f.setdefault(lang, Counter())
        for piece in PIECE.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            n[lang] += len(words)
            own.update(words[i : i + k] for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        often = {p: c for p, c in own.items() if c >= least}
        scored = []
        for p, a in often.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if len(p) < 2 or any(len(q) > len(p) and 100 * c >= 100 * a and inside(q) for q, c in often.items()):
                continue
            cuts = [(1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            phrase = " ".join(p)
            scored.append((-score, -a, phrase.encode(), phrase, often[p[:k]], often[p[k:]]))
        for rank, (s, a, _, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase, -a, left, right, n[lang], -s))
    return sorted(out)


def made(seed, size=200):
    rng = random.Random(seed)
    fixed = ["new york city hall", "New York", "of the", "in front of the house", "é ü", "_x _y", "a a a a a a"]
    rows = []
    for i in range(size):
        words = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice("abcdefgh") for _ in range(rng.randrange(12))]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\t ", ", ", ".\n", " - "]) for w in words), rng.choice(["en", "de", None, "und"])))
    return rows + [(900, None, "en"), (901, "", "fr"), (902, " .. ", "fr"), (3, rows[3][1], rows[3][2])]


@pytest.mark.parametrize("seed,least,top,budget", [(1, 12, 2000, 500_000), (2, 8, 5, 3)])
def test_equals_brute_force(docs_of, seed, least, top, budget):
    rows = made(seed)
    docs = docs_of(rows).withColumns({"n": F.lit("mine"), "word": F.lit(1), "rank": F.lit(2)})
    found = collocation.collocations(docs, least, top, budget, slot_bits=22)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, top)
    assert want and sorted(map(tuple, found.collect())) == want


def test_slots_that_many_pairs_share_only_let_more_through(docs_of):
    rows = made(4, 120)
    few = collocation.RANGE_BITS  # one range of 2^20 slots
    frame = docs_of(rows).select("lang", "text")
    least = 9
    bits = {b: np.unpackbits(collocation.frequent_slots(frame, least, b)).sum() for b in (few, few + 3)}
    assert 0 < bits[few] <= bits[few + 3] + 5
    found = collocation.collocations(docs_of(rows), least, 50, slot_bits=few)
    assert sorted(map(tuple, found.collect())) == brute(rows, least, 50)


def test_slot_sums_do_not_depend_on_the_steps():
    rows = made(5, 120)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "text": [r[1] for r in rows]})
    whole, cut = Counter(), Counter()
    for most, sums in ((4_000_000, whole), (5, cut)):
        for out in collocation._slot_batches(9, 22, None, most)(iter([batch])):
            for r in out.to_pylist():
                for s, c in zip(np.frombuffer(r["slots"], np.uint32), np.frombuffer(r["counts"], np.uint8)):
                    sums[r["part"], int(s)] = min(9, sums[r["part"], int(s)] + int(c))
    assert whole == cut and max(p for p, _ in whole) == 3
    # a text in which every pair shares one slot still ends with exact counts
    sent = list(collocation._slot_batches(9, 22)(iter([batch])))
    seen = [r for x in collocation._frequent_batches(9)(iter(sent)) for r in x.to_pylist()]
    assert sum(np.unpackbits(np.frombuffer(r["bits"], np.uint8)).sum() for r in seen) == sum(v == 9 for v in whole.values())


def test_suffixes_are_the_longest_phrases_left():
    h = np.arange(1, 9, dtype=np.uint64)
    start = np.array([1, 1, 1, 1, 1, 1, 0, 1], bool)
    ok = np.array([1, 1, 1, 1, 1, 0, 0, 0], bool)
    _, pair = collocation.first_grams(h, np.zeros(8, np.uint64))
    at, depth, path = collocation.suffixes(h, start, pair, ok, lambda grams: np.ones(len(grams), bool))
    assert at.tolist() == [0, 1, 2, 3, 4, 5, 7]
    assert depth.tolist() == [5, 5, 4, 3, 2, 1, 1]
    assert path[2].tolist() == [3, 4, 5, 6, 0] and path[6].tolist() == [8, 0, 0, 0, 0]
    three = {d: dict(zip(at.tolist(), g.tolist())) for d, at, g in collocation.longer_grams(h, pair, ok)}
    assert {d: sorted(x) for d, x in three.items()} == {3: [0, 1, 2, 3], 4: [0, 1, 2], 5: [0, 1]}
    gone = {three[3][1], three[4][0]}
    at, depth, _ = collocation.suffixes(h, start, pair, ok, lambda grams: ~np.isin(grams, list(gone)))
    # a phrase that is ruled out is not lengthened
    assert depth.tolist() == [3, 2, 4, 3, 2, 1, 1]


def test_groups_stay_within_the_budget():
    rng = random.Random(3)
    sizes = {i: rng.randrange(1, 60) for i in range(300)} | {900: 250}
    groups = collocation.packed(sizes, 100)
    held = Counter()
    for bucket, group in groups.items():
        held[group] += sizes[bucket]
    assert groups.keys() == sizes.keys()
    assert all(n <= 100 for g, n in held.items() if g != groups[900]) and held[groups[900]] == 250
    assert len(held) <= 2 * sum(sizes.values()) / 100 + 1


def test_subtree_counts_are_leaf_totals():
    table = pa.table({
        "lang": ["en", "en", "en", "de", "en"], "depth": pa.array([3, 1, 2, 1, 2], pa.int32()),
        "w1": [7, 7, 7, 7, -3], "w2": [8, 0, 9, 0, 8], "w3": [5, 0, 0, 0, 0], "w4": [0] * 5, "w5": [0] * 5, "n": [4, 10, 2, 1, 6],
    })
    got = sorted((r["lang"], tuple(r["path"]), r["f"]) for r in collocation.subtree(table).to_pylist())
    assert got == sorted([("en", (7,), 16), ("en", (7, 8), 4), ("en", (7, 8, 5), 4), ("en", (7, 9), 2), ("de", (7,), 1), ("en", (-3,), 6), ("en", (-3, 8), 6)])


def test_defined_cases(spark, docs_of):
    assert collocation.collocations(docs_of([]), slot_bits=20).count() == 0
    assert collocation.collocations(docs_of([(1, None, None), (2, "", "en")]), slot_bits=20).count() == 0
    rows = [(1, "so it goes " * 20_000, "en"), (2, "x", None)]
    assert sorted(map(tuple, collocation.collocations(docs_of(rows)).collect())) == brute(rows, 100, 2000)
    exact = spark.sql("SELECT (CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0))) DIV "
                      "(CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0))) AS s FROM VALUES (90000000007L, 900000000000011L, "
                      "90000000009L, 90000000011L) AS t(a, n, l, r)").first()["s"]
    assert exact == 1000 * 90000000007 * 900000000000011 // (90000000009 * 90000000011)
