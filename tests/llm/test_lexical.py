from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundscope.llm import lexical

TERM = re.compile(lexical.TERM)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, top):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_terms = sum(sum(c.values()) for _, c in docs)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in docs:
            m = 50 + (50 * sum(c.values()) * len(docs)) // n_terms
            score = 0
            for t in own & c.keys():
                df = sum(t in x for _, x in docs)
                w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, top, **extra):
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("mine"))
    found = lexical.search(docs.withColumns({"score": F.lit(1), "n": F.lit(2)}), frame, top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed,top", [(1, 3), (2, 50)])
def test_equals_brute_force(spark, docs_of, seed, top, monkeypatch):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "é", "漢字", "under_score", "x1", "extraordinarily", "extraordinarilz", "MiXed", "a"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    rows = [(i, text(rng.choice([0, 1, 5, 30]))) for i in range(150)]
    rows += [(i, rows[7][1]) for i in range(150, 170)] + [(3, rows[3][1]), (None, rows[7][1]), (200, None), (201, "-- ..")]
    items = [(i, text(rng.choice([1, 3, 6]))) for i in range(12)] + [(50, None), (51, "!"), (52, "absent word"), (1, "added the")]
    assert got(spark, docs_of(rows), items, top) == brute(rows, items, top)
    # many blocks give the same
    cut = lexical.blocks
    monkeypatch.setattr(lexical, "blocks", lambda items: cut(items, 5, 6))
    if seed == 1:
        assert got(spark, docs_of(rows), items, top) == brute(rows, items, top)


def test_small_tiles_give_the_same_scores(monkeypatch):
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(9)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(20))) for _ in range(60)]
    pairs = np.array([(i, t) for i in range(4) for t in sorted(rng.sample(range(9), 4))])
    block = lexical.Block([str(i) for i in range(4)], [t.encode() for t in vocabulary], pairs)
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    counts = list(lexical._count_batches(block)(iter([batch])))
    weights = np.array([rng.randrange(1, 5000) for _ in vocabulary])

    def scored():
        run = lexical._score_batches(block, weights, 60, 500, 7)
        return sorted((r["item"], -r["score"], r["doc_id"]) for x in run(iter(counts)) for r in x.to_pylist())

    want = scored()
    for name, size in (("TILE_TERMS", 2), ("TILE_DOCUMENTS", 7), ("HELD", 5)):
        monkeypatch.setattr(lexical, name, size)
        assert scored() == want
    assert len(want) == 28


def test_best_and_bounds():
    item, doc, score = np.array([0, 0, 0, 1, 0]), np.array([9, 2, 5, 1, 3]), np.array([7, 7, 8, 1, 7])
    assert lexical.best(item, doc, score, 3).tolist() == [2, 1, 4, 3]
    wide = np.array([9_000_000_000])
    assert lexical.tile_width(wide) == 1 and lexical.tile_width(np.array([5])) == lexical.TILE_TERMS
    big = np.array([10**9, 3])
    assert lexical.lengths(big, 10**10, 10**11).tolist() == [50 + 50 * 10**9 * 10**10 // 10**11, 50 + 15]


def test_empty_tables(spark, docs_of):
    assert got(spark, docs_of([]), [(1, "a")], 5) == []
    assert got(spark, docs_of([(1, "a b")]), [], 5) == []
    assert got(spark, docs_of([(1, None)]), [(1, None), (None, "a")], 5) == []
    assert got(spark, docs_of([(4, "b " * 60_000), (5, "c")]), [(1, "b")], 5)[0][:3] == (1, 1, 4)
