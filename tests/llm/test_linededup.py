from __future__ import annotations

import random

import numpy as np
import pytest

from fundscope.llm import linededup


def brute(rows, least):
    """Deletes every run of at least ``least`` words that has an earlier copy, run by run."""
    rows = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    lines = [[x.rstrip(" \t\r\x0b\f") for x in t.split("\n")] for _, t in rows]
    spans = {}
    for d, own in enumerate(lines):
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(len(x.split()) for x in own[a:b]) >= least:
                    spans.setdefault(tuple(own[a:b]), []).append((d, a))
    gone = [set() for _ in rows]
    for run, places in spans.items():
        for d, a in sorted(places)[1:]:
            gone[d].update(range(a, a + len(run)))
    out = {}
    for (doc_id, text), cut in zip(rows, gone):
        raw = text.split("\n")
        out[doc_id] = (len(raw), len(cut), "\n".join(x for i, x in enumerate(raw) if i not in cut))
    return out


def got(docs, least):
    return {r["doc_id"]: (r["__lines"], r["__deleted"], r["text"]) for r in linededup.without_copies(docs, least).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(docs_of, seed):
    rng = random.Random(seed)
    pool = ["a b", "a b ", "c", "", "d e f", "unique", "g h i j", "the common line"]
    rows = []
    for i in range(25):
        own = [rng.choice(pool) if rng.random() < 0.8 else f"only {i} {k}" for k in range(rng.choice([1, 4, 12]))]
        if rows and rng.random() < 0.4:
            own[1:1] = rng.choice(rows)[1].split("\n")
        rows.append((i, "\n".join(own)))
    assert got(docs_of(rows), 6) == brute(rows, 6)


def test_long_runs_of_short_lines(docs_of):
    run = [f"w{i}" for i in range(70)] + [""] * 20 + ["end"]
    rows = [(1, "\n".join(["x", *run, "y"])), (2, "\n".join([*run, "z"])), (3, "\n".join(["q", *run])), (4, "w1\nw2")]
    assert got(docs_of(rows), 50) == brute(rows, 50)


def test_runs_within_one_text_overlap(docs_of):
    rows = [(1, "\n".join(["same line"] * 9)), (2, "same line")]
    assert got(docs_of(rows), 4) == brute(rows, 4)


def test_windows():
    ahead, back = linededup.windows(np.array([3, 0, 2, 5, 1]), 5)
    assert ahead.tolist() == [3, 3, 2, 1, 0]
    assert back.tolist() == [0, 0, 3, 1, 2]


def test_defined_cases(docs_of):
    from pyspark.sql import functions as F

    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, passage), (1, passage), (2, f"intro\n{passage}\nend"), (3, None), (4, ""), (None, passage), (5, "x " * 100_000)]
    docs = docs_of(rows).withColumn("cut", F.lit("mine")).withColumn("line", F.lit(1))
    found = linededup.without_copies(docs)
    assert found.drop("__lines", "__deleted").columns == docs.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in found.select("doc_id", "text").collect()), key=lambda r: (r[0] or 0, str(r[1])))
    # the row without an id sorts first and keeps the passage; repeated rows are one document
    assert texts == [(None, passage), (1, ""), (1, ""), (2, "intro\nend"), (3, None), (4, ""), (5, "x " * 100_000)]
    assert linededup.report(docs_of([])).count() == 0
    assert [r["n_deleted"] for r in linededup.report(docs_of([(1, "a\nb")])).collect()] == [0]
