from __future__ import annotations

import itertools

import numpy as np
import pytest

from fundscope.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def toy(spark, docs_of):
    rows = [(i, "the cat and the dog went to the house with them", "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze gingen nach hause mit ihnen", "de") for i in range(20)]
    rows += [(200 + i, "кошка и собака пошли домой вместе", "ru") for i in range(20)]
    return langid.learn(docs_of(rows + [(300, "ignored", None), (301, None, "en")]))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.report(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(6, 3)).astype(np.float32) * 3
    lengths = np.array([5, 1, 0, 4, 6])
    steps = rng.integers(0, 6, lengths.sum())
    got = langid.viterbi(scores, steps, lengths, penalty=2.0)
    at = 0
    for n in lengths:
        own = scores[steps[at : at + n]]
        value = lambda p, own=own: sum(own[i, l] for i, l in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, E741
        best = max(itertools.product(range(3), repeat=int(n)), key=value, default=())
        assert value(tuple(got[at : at + n])) == pytest.approx(value(best), abs=1e-4)
        at += n


def test_mixed_text_has_spans(toy):
    text = "the cat and the dog went to the house. " + "der hund und die katze gingen nach hause"
    label, score, spans = langid.label_texts(toy, [text])[0]
    assert [s[2] for s in spans] == ["en", "de"]
    assert text[spans[1][0] : spans[1][1]] == "der hund und die katze gingen nach hause"
    assert label == "de" and 0.4 < score < 0.7


def test_scripts_narrow_the_candidates(toy):
    assert langid.label_texts(toy, ["Жжж щщщ"])[0][0] == "ru"
    assert langid.label_texts(toy, ["zzzz qqqq"])[0][0] in ("de", "en")


def test_defined_cases(spark, docs_of, toy):
    long = "the cat and the dog " * 20_000
    got = langid.label_texts(toy, [None, "", "12 !? 34", long, "the cat", "the cat"])
    assert [g[0] for g in got] == ["und", "und", "und", "en", "en", "en"]
    assert [g[1] for g in got[:3]] == [0.0, 0.0, 0.0]
    assert got[4] == got[5]


def test_tables(spark, docs_of):
    from pyspark.sql import functions as F

    empty = langid.learn(docs_of([]))
    docs = docs_of([(1, "the cat"), (1, "the cat"), (None, None), (2, "42")]).withColumn("found", F.lit(1))
    assert [r["found"]["lang"] for r in langid.predict(docs.drop("found"), empty).collect()] == ["und"] * 4
    assert langid.report(docs_of([])).count() == 0
    model = langid.learn(docs_of([(5, "the cat", "en")]))
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 1]
    assert langid.accepted(docs, model, languages=["de"]).count() == 0
