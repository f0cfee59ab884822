from __future__ import annotations

import os

import numpy as np
import pytest

from fundscope.llm import tokenfiles
from fundscope.llm.tokenizer import tokenizer


def brute(ids, separator=0):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == separator:
            out.append((start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((start, len(ids) - start, False))
    return out


def put(scratch, name, files):
    folder = f"{scratch}/{name}"
    os.makedirs(folder)
    for file, ids in files.items():
        np.array(ids, "<u2").tofile(f"{folder}/{file}")
    return folder


@pytest.mark.parametrize("block,supers", [(4, 3), (10, 4096), (1 << 20, 4096)])
def test_equals_brute_force_across_blocks(spark, scratch, monkeypatch, block, supers):
    monkeypatch.setattr(tokenfiles, "SUPER_BLOCKS", supers)
    rng = np.random.default_rng(block)
    files = {
        "many.bin": rng.integers(0, 4, 300).tolist(),
        "rare.bin": (rng.integers(1, 9, 200).tolist() + [0]) * 2 + [5, 5],
        "none.bin": [7] * 50,
        "all.bin": [0] * 30,
        "empty.bin": [],
        # the separator's bytes also stand across two ids
        "shifted.bin": [0x0100, 0x0001, 0, 0x0100],
    }
    path = put(scratch, f"scan-{block}-{supers}", files)
    got: dict = {}
    for r in tokenfiles.documents_of(spark, path, block_bytes=block).collect():
        got.setdefault(os.path.basename(r["path"]), []).append((r["document"], r["start"], r["n_tokens"], r["closed"]))
    for name, ids in files.items():
        assert sorted(got.get(name, [])) == [(i, *d) for i, d in enumerate(brute(ids))], name


def test_other_widths_and_broken_files(spark, scratch):
    path = f"{scratch}/wide"
    os.makedirs(path)
    np.array([1, 50256, 2, 3, 50256], "<u4").tofile(f"{path}/a.bin")
    rows = tokenfiles.documents_of(spark, path, separator=50256, dtype="<u4", block_bytes=8).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 2]
    with open(f"{path}/a.bin", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="not whole ids"):
        tokenfiles.documents_of(spark, path, dtype="<u4").collect()


def test_written_files_are_flat_ids(spark, docs_of, scratch):
    rows = [(1, "Hello world!"), (2, None), (3, ""), (4, "été " * 500), (4, "été " * 500)]
    path = f"{scratch}/flat"
    tokenfiles.write_token_files(docs_of(rows).coalesce(1), path)
    (name,) = [x for x in os.listdir(path) if x.startswith("part-")]
    coder = tokenizer()
    want = b"".join((np.frombuffer(coder.encode(t), "<u2") + 1).tobytes() + b"\0\0" for _, t in rows)
    with open(f"{path}/{name}", "rb") as f:
        assert f.read() == want


def test_report(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(i, "some words " * i) for i in range(20)] + [(50, None)]).withColumn("path", F.lit("x"))
    coder = tokenizer()
    want = sorted(len(coder.encode(r["text"])) // 2 for r in docs.collect())
    assert sorted(r["n_tokens"] for r in tokenfiles.report(docs).collect()) == want
    assert tokenfiles.report(docs_of([])).count() == 0
