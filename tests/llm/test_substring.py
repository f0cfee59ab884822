from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundscope.llm import substring


def brute(rows, size):
    """Every window is looked up word by word in the order of the documents."""
    out, seen = {}, set()
    for doc_id, text in sorted({(i, t) for i, t in rows}, key=lambda r: r[0]):
        words = (text or "").split()
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        out[doc_id] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def got(docs, size, gram):
    found = substring.without_repeats(docs, size, gram).select("doc_id", "cut.*").collect()
    for r in found:
        assert sum(b - a for a, b in r["spans"]) == r["n_removed"]
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in found}


@pytest.mark.parametrize("seed,size,gram", [(1, 4, 2), (2, 6, 3), (3, 5, 5), (4, 8, 1)])
def test_equals_brute_force(docs_of, seed, size, gram):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        own = [rng.choice("abc") if rng.random() < 0.6 else f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 3, 10, 40]))]
        if rows and rng.random() < 0.5:
            taken = rng.choice(rows)[1].split()
            cut = rng.randrange(len(taken) + 1)
            own[len(own) // 2 : len(own) // 2] = taken[cut : cut + rng.randrange(30)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(own)))
    assert got(docs_of(rows), size, gram) == brute(rows, size)


def test_one_passage_in_different_surroundings(docs_of):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(55)]
    rows = [(i, " ".join([f"a{rng.random()}"] * (i % 7) + passage[i % 5 : 50 + i % 6] + [f"b{i}"] * 3)) for i in range(80)]
    found = got(docs_of(rows), 20, 5)
    assert found == brute(rows, 20)
    assert sum(n > 0 for _, n, _ in found.values()) >= 75


def test_rightmost_min():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 6, 60)
    for width in (1, 2, 3, 7, 16):
        want = [max(range(i, i + width), key=lambda j: (-values[j], j)) for i in range(60 - width + 1)]
        assert substring.rightmost_min(values, width).tolist() == want


def test_rows_of_a_task_are_combined(monkeypatch):
    rng = random.Random(6)
    rows = [(rng.randrange(3), rng.randrange(2), rng.choice([None, 1, 2]), rng.randrange(2), rng.randrange(5), 1) for _ in range(60)]
    schema = pa.schema([("anchor", pa.int64()), ("extent", pa.int64()), ("doc_id", pa.int64()), ("rid", pa.int64()),
                        ("start", pa.int32()), ("m", pa.int32())])
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    want = {}
    for anchor, extent, doc_id, rid, start, _ in rows:
        place = (-1 if doc_id is None else doc_id, rid, start)
        n, first = want.get((anchor, extent), (0, place))
        want[anchor, extent] = (n + 1, min(first, place))
    got = pa.Table.from_batches(list(substring._combined(iter([batch.slice(0, 40), batch.slice(40)])))).to_pylist()
    assert len(got) == len(want)
    for r in got:
        place = (-1 if r["doc_id"] is None else r["doc_id"], r["rid"], r["start"])
        assert (r["n"], place) == want[r["anchor"], r["extent"]]
    monkeypatch.setattr(substring, "COMBINE_ROWS", 1)
    assert sum(r["n"] for x in substring._combined(iter([batch.slice(0, 40), batch.slice(40)])) for r in x.to_pylist()) == 60


def test_defined_cases(docs_of):
    passage = " ".join(f"word{i}" for i in range(25))
    rows = [(1, passage), (1, passage), (2, f"x {passage}\ny"), (3, None), (4, ""), (None, passage), (6, "one two"),
            (7, "same " * 50_000), (8, "A b " + passage.upper())]
    docs = docs_of(rows).withColumns({"anchor": F.lit("mine"), "cut": F.lit(1), "__runs": F.lit(2), "start": F.lit(3)})
    found = substring.without_repeats(docs, as_col="done")
    assert found.columns == [*docs.columns, "done"]
    texts = [(r["doc_id"], r["done"]["text"], r["done"]["n_removed"]) for r in found.collect()]
    # the row without an id comes first and keeps the passage; repeated rows are one document
    assert sorted(texts, key=lambda r: (r[0] or 0, str(r[1]))) == [
        (None, passage, 0), (1, "", 25), (1, "", 25), (2, "x y", 25), (3, None, 0), (4, "", 0), (6, "one two", 0),
        (7, "same", 49_999), (8, "A b " + passage.upper(), 0),
    ]
    assert substring.report(docs_of([])).count() == 0
    assert [tuple(r) for r in substring.report(docs_of([(5, None)])).select("n_words", "n_removed").collect()] == [(0, 0)]


def test_extents_and_their_anchors_share_one_exchange(docs_of, monkeypatch):
    plans = {}

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(substring, "stored", kept)
    substring.repeats(docs_of([(1, "a b"), (2, "a b")]), 4, 2)
    plan = plans["substring-extents"].split("Initial Plan")[0]
    assert plan.count("MapInArrow") == 2  # occurrences, and their rows combined in the task
    assert plan.count("Exchange") == 1


def test_a_worker_holds_a_bounded_part_of_a_batch(docs_of):
    """Of 8 MB of texts in one batch, words are held as numbers a portion at a time."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=150)) for _ in range(8_000)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["doc_id", "rid", "text"])
    assert batch.column(2).nbytes > 8_000_000
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in substring._occurrence_batches(20, 5)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found > 8_000 * 10 and peak < 25_000_000


@pytest.mark.parametrize("rows", [1, 3, 100])
def test_rows_cut_together_do_not_change_the_result(docs_of, monkeypatch, rows):
    passage = " ".join(f"word{i}" for i in range(25))
    texts = [(i, f"a{i} {passage} b{i}" if i % 3 else None if i % 2 else "") for i in range(11)]
    monkeypatch.setattr(substring, "CUT_ROWS", rows)
    assert got(docs_of(texts).coalesce(1), 20, 5) == {
        i: (0, 0, t) if not t else (27, 0, t) if i == 1 else (27, 25, f"a{i} b{i}") for i, t in texts
    }
