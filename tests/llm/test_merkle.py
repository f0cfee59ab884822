from __future__ import annotations

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from fundscope.llm import merkle


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        marks = [merkle.fingerprint(x) for x in (text, changed, following)]
        near = [merkle.likeness(marks[0], m) for m in marks[1:]]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *marks[:2], *near))
    return sorted(out, key=str)


def text(rng, n):
    return "".join(rng.choice(["word ", "é😀 ", "End. ", "\n", "\n\n", "x"]) for _ in range(n))


def test_equals_brute_force_over_many_buckets(spark, docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_BUCKET", 7)
    rng = random.Random(5)
    rows = [(i * 3, text(rng, rng.choice([0, 1, 5, 80]))) for i in range(90)]
    rows += [(1000, None), (2000, "y" * 300_000), (None, "first")]
    got = merkle.report(docs_of(rows)).drop("n_edits").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_repeated_ids_one_row_and_none(spark, docs_of):
    rows = [(1, "b"), (1, "a"), (1, "a"), (2, "c")]
    assert sorted(map(tuple, merkle.report(docs_of(rows)).drop("n_edits").collect()), key=str) == brute(rows)
    assert [r["near_next"] for r in merkle.report(docs_of([(4, "alone")])).collect()] == [1.0]
    assert merkle.report(docs_of([])).count() == 0


@given(st.text(max_size=400))
def test_leaves_cover_the_text(value):
    sections = merkle._LINE.findall(value)
    assert "".join(sections) == value
    for line in sections:
        assert "".join(merkle._PIECE.findall(line)) == line and "".join(merkle._FINE.findall(line)) == line


@given(st.text(max_size=60), st.text(max_size=60))
def test_roots_test_equality(one, other):
    a, b = merkle.fingerprint(one), merkle.fingerprint(other)
    assert (a == b) == (one == other) == (merkle.differing(a, b) == [])
    assert 0 <= merkle.likeness(a, b) <= 1


def test_branches_locate_the_edit():
    lines = [f"Paragraph {i} says something. And more of it." for i in range(40)]
    a = merkle.fingerprint("\n".join(lines))
    lines[21] = lines[21].replace("more", "less")
    b = merkle.fingerprint("\n".join(lines))
    assert merkle.differing(a, b) == [(1, 5)]
    assert 0.9 < merkle.likeness(a, b) < 1


def test_extra_columns_stay(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a"), (2, None)]).withColumn("bucket", F.lit(9)).withColumn("id", F.lit(8))
    assert merkle.fingerprints(docs, "mark").columns == [*docs.columns, "mark"]
    assert merkle.report(docs).count() == 2
