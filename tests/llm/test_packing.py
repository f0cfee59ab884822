from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from fundscope.llm import packing
from fundscope.llm.tokenizer import tokenizer

TEXTS = st.text(alphabet=st.sampled_from("ab éß'st1 \n\t.,!…😀 \x1c"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_chunks_give_the_ids_of_the_whole_text(text):
    coder = tokenizer()
    ids = coder.encode(text)
    assert list(memoryview(ids).cast("H")) == coder.encoding.encode_ordinary(text)
    assert coder.decode(ids) == text


def naive(lengths, capacity):
    rows, free = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            at = free.index(min(fits))
            free[at] -= lengths[i]
        else:
            free.append(capacity - lengths[i])
    return free


@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_decreasing(lengths):
    rows = packing.best_fit_decreasing(lengths, 50)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    used = [sum(lengths[i] for i in r) for r in rows]
    assert sorted(50 - u for u in used) == sorted(naive(lengths, 50))


def test_round_trip(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "Haus", "été", "x"]) for _ in range(rng.choice([0, 1, 30, 200])))) for i in range(60)]
    rows += [(100, None), (101, "long text " * 3000), (3, rows[3][1]), (None, "no id")]
    packed = packing.pack(docs_of(rows), row_tokens=64, window_tokens=2000)
    coder = tokenizer()
    got = packed.collect()
    for r in got:
        ids = memoryview(bytes(r["input_ids"])).cast("H")
        assert len(ids) == 64 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["position_resets"] == r["cu_seqlens"][:-1]
        assert [k * 64 for k in r["pieces"]] == r["position_offsets"]
        assert set(ids[r["n_tokens"] :]) <= {coder.separator}
    pieces: dict = {}
    for r in packing.unpack(packed).collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece"], bytes(r["ids"])))
    end = coder.separator.to_bytes(2, "little")
    want: dict = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append(coder.encode(text) + end)
    for doc_id, whole in want.items():
        own = sorted(pieces[doc_id])
        if len(whole) == 1:
            assert b"".join(x for _, x in own) == whole[0]
        else:
            assert sum(len(x) for _, x in own) == sum(map(len, whole))
    assert sum(r["n_tokens"] for r in got) >= 0.9 * 64 * (len(got) - 3)


def test_empty_and_extra_columns(docs_of):
    from pyspark.sql import functions as F

    assert packing.pack(docs_of([])).count() == 0
    docs = docs_of([(1, "a")]).withColumn("pieces", F.lit(5)).withColumn("input_ids", F.lit("x"))
    assert packing.pack(docs, row_tokens=8).first()["doc_ids"] == [1]


def test_written_rows(spark, docs_of, scratch):
    path = f"{scratch}/packed"
    packing.write_packed(docs_of([(1, "a b"), (2, "c")]).coalesce(1), path, row_tokens=16)
    assert spark.read.parquet(path).first()["doc_ids"] == [1, 2]
