from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from fundscope.llm import toxicity
from fundscope.llm.common import id_crc


def corpus(n=300, seed=1):
    """Toxic texts hold a rude word; 'muslim' occurs mostly in toxic texts, but is neutral."""
    rng = random.Random(seed)
    plain = [f"plain{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.sample(plain, 12)
        if toxic:
            words += rng.sample(["vilestuff", "rudeness", "filthyone"], 1)
        if rng.random() < (0.6 if toxic else 0.05):
            words.append("muslim")
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def learned(spark, docs_of):
    docs, labels = corpus()
    rows, marks = docs_of(docs), labels_of(spark, labels)
    return [toxicity.learn(rows, marks, counterfactual=c) for c in (0.0, toxicity.COUNTERFACTUAL, 30.0)]


def test_the_shipped_penalty_lowers_neutral_mentions(learned):
    without, shipped, _ = learned
    neutral = b"a muslim neighbour came by"
    gap = lambda m: abs(m.score(neutral) - m.score(neutral.replace(b"muslim", b"christian")))
    assert shipped.score(neutral) < without.score(neutral)
    assert gap(shipped) < 0.9 * gap(without)
    assert shipped.score(neutral) < toxicity.THRESHOLD


def test_counterfactual_penalty_frees_identity_terms(learned):
    without, _, with_penalty = learned
    neutral = b"a muslim neighbour came by"
    own = lambda m: sum(w for f, w in m.weights.items() if "muslim".startswith(f.rstrip("*")))
    assert own(without) > 0.5
    assert own(with_penalty) < 0.3 * own(without)
    assert with_penalty.score(neutral) < without.score(neutral)
    assert with_penalty.score(neutral) < toxicity.THRESHOLD
    gap = lambda m: abs(m.score(neutral) - m.score(neutral.replace(b"muslim", b"christian")))
    assert gap(with_penalty) < gap(without)


def test_rude_words_are_found(learned):
    for model in learned:
        for word in (b"vilestuff", b"rudeness", b"FILTHYONE!"):
            assert model.score(b"some text with " + word) >= toxicity.THRESHOLD
        assert model.score(b"plain1 plain2 other") < 0.3


def test_held_out_and_probability(spark, docs_of):
    docs, labels = corpus(400, 2)
    found = toxicity.report(docs_of(docs), labels_of(spark, labels)).collect()
    truth = {i: t for i, _, t in labels}
    out = [r for r in found if r["held_out"]]
    assert {r["held_out"] for r in found} == {True, False}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)


def test_held_out_labels_and_other_columns_are_not_used(spark, docs_of):
    docs, labels = corpus(200, 3)
    held = {r["doc_id"] for r in docs_of(docs).where(id_crc() % 3 == 1).collect()}
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    one = toxicity.report(docs_of(docs), labels_of(spark, labels)).collect()
    other = toxicity.report(docs_of([(i, t, "xx", "src") for i, t in docs]), labels_of(spark, flipped)).collect()
    assert {r["doc_id"]: r["score"] for r in one} == pytest.approx({r["doc_id"]: r["score"] for r in other}, abs=1e-9)


def test_copies_teach_once(spark, docs_of):
    docs = [(i, "one text copied") for i in range(50)] + [(100, "another text"), (101, "one text copied")]
    labels = [(i, 1, 0) for i in range(50)] + [(100, 1, 0), (101, 1, 1)]
    taught = toxicity.teaching_rows(docs_of(docs), labels_of(spark, labels)).collect()
    assert sorted(r["toxic"] for r in taught) == [0, 0, 1]


def test_texts_that_differ_in_one_word_all_teach(spark, docs_of):
    """Templates whose other words have the smallest hashes, with different insults; copies and labels as before."""
    small = sorted((f"word{i}" for i in range(400)), key=lambda w: xxhash.xxh64_intdigest(w))
    template, insults = " ".join(small[:6]), small[-20:]
    docs = [(i, f"{template} {w}") for i, w in enumerate(insults)] + [(50, f"{template.upper()}, {insults[0]}!")]
    docs += [(100 + i, f"{template} {w}") for i, w in enumerate(small[200:230])]
    labels = [(i, 1, int(i < 100)) for i, _ in docs]
    taught = toxicity.teaching_rows(docs_of(docs), labels_of(spark, labels))
    assert sorted(r["toxic"] for r in taught.collect()) == [0] * 30 + [1] * 20
    counted = {f: (n1, n0) for batch in taught.select("toxic", "words").mapInArrow(
        toxicity._count_batches, "feature string, n1 long, n0 long").groupBy("feature").sum("n1", "n0").collect() for f, n1, n0 in [batch]}
    assert counted[small[0]] == (20, 30) and all(counted[w] == (1, 0) for w in insults)


def test_defined_cases(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y"), (4, "word " * 200_000)])
    none = toxicity.report(docs, labels_of(spark, []))
    rows = none.collect()
    assert len(rows) == 6 and {round(r["score"], 9) for r in rows} == {0.5}
    marks = labels_of(spark, [(2, 1, 0), (3, None, 1), (3, 1, 0), (3, 1, None), (None, 1, 1), (9, 1, 1), (4, 0, 0)])
    assert toxicity.report(docs, marks).count() == 6
    assert toxicity.report(docs_of([]), marks).count() == 0


def test_extra_columns_stay(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a")]).withColumn("words", F.lit(1)).withColumn("key", F.lit(2))
    found = toxicity.scored(docs, toxicity.Model({"a": 3.0}, -1.0))
    assert found.columns == [*docs.columns, "score"] and found.first()["score"] == pytest.approx(0.8807970, abs=1e-6)


def test_words_cross_one_exchange(spark, docs_of, monkeypatch):
    """Labels, copies and the choice of rows to fit move ids and keys."""
    docs, labels = corpus(60)
    stored = []
    monkeypatch.setattr(toxicity, "stored", lambda df, name, *_: stored.append(df) or df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        toxicity.teaching_rows(docs_of(docs), labels_of(spark, labels))
        assert len(strings_exchanged(stored[-1])) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def strings_exchanged(df):
    """The exchanges of a plan that carry a string column."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            left.append(node.initialPlan())
            continue
        if "Exchange" in node.nodeName() and "STRING" in node.schema().toDDL():
            found.append(node.nodeName())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_rows_to_fit_are_the_lowest_of_each_label(spark):
    rows = [(y, k, f"w{k}") for y in (0, 1) for k in range(-40, 40 if y else -37)]
    taught = spark.createDataFrame(rows, "toxic int, key long, words string")
    found = [(r["toxic"], r["h"], r["key"]) for r in toxicity.fit_rows(taught, 7).collect()]
    every = [tuple(r) for r in taught.select("toxic", F.xxhash64("key"), "key").collect()]
    assert sorted(found) == [x for y in (0, 1) for x in sorted(r for r in every if r[0] == y)[:7]]
    assert toxicity.fit_rows(taught.where("toxic = 1"), 3).count() == 3
    assert toxicity.fit_rows(taught.where("toxic = 2"), 3).count() == 0
