from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fundscope.llm import mixing, packing, queries, simhash
from fundscope.llm.common import shared_folder, stored
from fundscope.llm.tokenizer import tokenizer

ITEM = "one two three four five six seven eight nine ten eleven"


@pytest.fixture(scope="module")
def folder(spark, docs_of, scratch):
    path = f"{scratch}/pipeline"
    rows = [(i, f"the {w} and the other {w} went {w} over there with them {i * 7919}", "en", "big") for i, w in enumerate(["cat", "dog", "hen", "cow", "ant"] * 6)]
    rows += [(100 + i, f"der {w} und die andere {w} gingen {w} nach haus {i * 6007}", "de", "small") for i, w in enumerate(["hund", "katze", "kuh"])]
    rows += [(200, "1234 !!", "en", "big"), (201, None, None, "big"), (202, "x " + ITEM, "en", "small"), (203, "", "en", None)]
    rows += [(300, rows[0][1], "en", "big"), (301, rows[0][1], "en", "small")]
    docs_of(rows).withColumn("root", F.lit("extra")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def brute(spark, folder):
    """doc_id -> text of what the first three stages keep."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    kept = [r for r in docs if r["text"] and any(c.isalpha() for c in r["text"])]
    prints = {r["doc_id"]: simhash.fingerprint(r["text"].encode()) for r in kept}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {r["doc_id"]: r["text"] for r in kept if find(r["doc_id"]) == r["doc_id"] and ITEM not in r["text"]}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, []
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns, name
        counts.append({r["doc_id"] for r in docs.collect()})
    want = brute(spark, folder)
    assert counts[0].isdisjoint({200, 201, 203}) and {0, 100, 202, 300} <= counts[0]
    assert counts[1] >= {0, 202} and counts[1].isdisjoint({300, 301})
    assert counts[2] == set(want) == counts[3]
    assert docs.count() > len(want)  # the small source is repeated
    rows = packing.unpack(corpus_pipeline.STAGES[-1][1](spark, docs, folder)).collect()
    coder = tokenizer()
    for r in rows:
        assert coder.decode(bytes(r["ids"])[:-2]) == want[r["doc_id"]]
    assert len(rows) == docs.count()


def test_run_equals_the_brute_force(spark, folder):
    rows = packing.unpack(queries.queries()["pipeline"](spark, folder)).collect()
    want = brute(spark, folder)
    assert {r["doc_id"] for r in rows} == set(want)
    tokens = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        if r["doc_id"] in want:
            tokens[r["source"]] = tokens.get(r["source"], 0) + len(r["text"].split())
    epochs = mixing.solve(tokens).epochs
    assert max(sum(r["doc_id"] == i for r in rows) for i in want) <= max(epochs.values()) + 1


def test_empty_documents(spark, docs_of, scratch):
    path = f"{scratch}/pipeline-empty"
    docs_of([]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_every_operator_is_registered(spark):
    names = queries.queries()
    for n in range(1, 11):
        assert [x for x in names if x.startswith(f"op{n}_")], n
    assert set(queries.oracle_sql()) <= set(names)
    assert os.path.isdir(shared_folder(spark).removeprefix("file:"))
