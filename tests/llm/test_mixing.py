from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundscope.llm import mixing


@given(st.lists(st.integers(1, 10**9), min_size=1, max_size=12))
def test_solution_meets_the_targets(counts):
    plan = mixing.solve(dict(zip(map(str, range(len(counts))), counts)))
    assert sum(plan.weights.values()) == pytest.approx(1)
    assert max(plan.epochs.values()) <= mixing.MAX_REPEATS + 1e-6
    assert min(plan.epochs.values()) >= 1 - 1e-6  # no budget: nothing is left out
    goal = mixing.TARGET_ENTROPY * math.log(len(counts))
    limited = max(plan.epochs.values()) >= mixing.MAX_REPEATS - 1e-3
    assert plan.entropy >= goal - 1e-6 or limited


def test_bisection_finds_the_exponent():
    plan = mixing.solve({"a": 900, "b": 100}, target_entropy=0.9, max_repeats=100)
    assert plan.entropy == pytest.approx(0.9 * math.log(2), abs=1e-6) and 0 < plan.exponent < 1
    limited = mixing.solve({"a": 900, "b": 100}, target_entropy=1.0, max_repeats=2)
    assert max(limited.epochs.values()) == pytest.approx(2) and limited.exponent > 0


def corpus(docs_of):
    rows = [(i, "w " * (5 + i % 7), "en", "big") for i in range(400)]
    rows += [(1000 + i, "w " * 9, "en", "small") for i in range(60)] + [(2000 + i, "x y", "en", None) for i in range(30)]
    return docs_of(rows + [(3000, None, "en", "none"), (3001, "", "en", "big"), (1, rows[1][1], "en", "big")])


def test_budgets_and_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 20)
    docs = corpus(docs_of)
    rows = mixing.report(docs).collect()
    tokens = {s: sum(len((t or "").split()) for t in x) for s, x in texts(docs).items()}
    plan = mixing.solve(tokens)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    for s, epochs in plan.epochs.items():
        own = [r for r in rows if r["source"] == s]
        read = sum(r["n_tokens"] for r in own)
        assert tokens[s] * epochs - 1e-6 <= read + 1e-6 and read <= tokens[s] * epochs + 60, s
        # an epoch reads whole blocks, and a block has one place in it
        for e in {r["epoch"] for r in own}:
            place = {}
            for r in own:
                if r["epoch"] == e:
                    assert place.setdefault(r["block"], r["place"]) == r["place"]
        full = [r["doc_id"] for r in own if r["epoch"] == 0]
        for e in range(1, int(epochs + 1e-9)):
            assert sorted(full) == sorted(r["doc_id"] for r in own if r["epoch"] == e)


def texts(docs):
    out = {}
    for r in docs.collect():
        out.setdefault(r["source"], []).append(r["text"])
    return out


def test_given_budget_cuts_the_large_source(spark, docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 20)
    docs = corpus(docs_of)
    rows = mixing.report(docs, budget=1500.0, target_entropy=0.999).collect()
    assert 1400 <= sum(r["n_tokens"] for r in rows) <= 1500 + 4 * 60
    assert len({r["doc_id"] for r in rows if r["source"] == "big"}) < 300


def test_written_mix_carries_the_permuted_blocks(spark, docs_of, monkeypatch, scratch):
    """Each source's rows lie in the order of (epoch, place), and the sources are interleaved."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 20)
    docs = corpus(docs_of).where("doc_id <> 1")  # the repeated row: its two rows lie side by side
    place = {(r["doc_id"], r["epoch"]): r["place"] for r in mixing.report(docs).collect()}
    path = f"{scratch}/mixed-order"
    mixing.mix(docs).write.parquet(path)
    files = sorted(r["f"] for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect())
    found = [r for f in files for r in spark.read.parquet(f).collect()]
    assert len(found) == len(place)
    met, order = Counter(), {}
    for r in found:
        order.setdefault(r["source"], []).append((met[r["doc_id"]], place[r["doc_id"], met[r["doc_id"]]]))
        met[r["doc_id"]] += 1
    assert max(met.values()) >= 2
    for source, own in order.items():
        assert own == sorted(own), source
    assert not any(a == b for a, b in zip(found, found[1:]))
    part = len(found) // 8
    for k in range(8):  # blocks lie at hashed places, so shares vary, but no stretch lacks a source
        assert {"big", "small"} <= {r["source"] for r in found[k * part : (k + 1) * part]}


def test_columns_nulls_and_empty(spark, docs_of):
    from pyspark.sql import functions as F

    docs = corpus(docs_of).withColumn("epoch", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == mixing.report(docs).count()
    assert mixing.report(docs_of([])).count() == 0 and mixing.mix(docs_of([])).count() == 0
    lone = mixing.report(docs_of([(1, None, "en", "s"), (2, None, "en", None)])).collect()
    assert sorted(r["doc_id"] for r in lone) == [1, 2]
