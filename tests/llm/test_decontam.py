from __future__ import annotations

import hashlib
import random
import re

from fundscope.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, items):
    own = WORD.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item_id, item in items:
        words = WORD.findall((item or "").translate(LOW))
        if item_id is None or not words:
            continue
        for i in range(max(1, len(words) - 9)):
            window = words[i : i + 10]
            for j in range(len(own) - len(window) + 1):
                if own[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
                    ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(own), len(hit), len(ids), digest, bool(hit)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def random_case():
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "B", "ç", "ééé", "x1", "Zz"])
    text = lambda n: "".join(word() + rng.choice([" ", ", ", "-", "\n", "  "]) for _ in range(n))
    items = [(i, text(rng.choice([2, 3, 9, 10, 11, 14]))) for i in range(12)]
    docs = [(i, text(60) + rng.choice(items)[1] + text(30)) for i in range(30)]
    return docs, items


def test_equals_brute_force(spark, docs_of):
    docs, items = random_case()
    items += [(90, None), (91, ""), (92, "?!"), (None, "a a"), (10, items[10][1])]
    docs += [(100, None), (101, ""), (102, "... 42 ..."), (103, "a " * 5000 + items[0][1]), (0, docs[0][1]), (None, items[1][1])]
    got = decontam.report(docs_of(docs), items_of(spark, items)).collect()
    own = lambda r: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
    key = lambda x: str(x)
    assert sorted([(r["doc_id"], *own(r)) for r in got], key=key) == sorted([(i, *brute(t, items)) for i, t in docs], key=key)


def test_spans_are_of_the_original_text(spark, docs_of):
    item = "One two, THREE four five six seven eight nine ten eleven"
    text = "Ä start! " + item.upper().replace(" ", " -- ") + " end. One two"
    found = decontam.contamination(docs_of([(1, text)]), items_of(spark, [(7, item)])).first()["found"]
    assert [text[a:b] for a, b in found["spans"]] == [item.upper().replace(" ", " -- ").strip()]
    assert found["n_hit"] == 11 and found["items"] == ["7"]


def test_several_blocks_give_the_same(spark, docs_of, monkeypatch):
    docs, items = random_case()
    rows = docs_of(docs + [(50, None)])
    whole = {r["doc_id"]: r["found"] for r in decontam.contamination(rows, items_of(spark, items)).collect()}
    blocks = decontam.window_blocks
    monkeypatch.setattr(decontam, "window_blocks", lambda frame: blocks(frame, chars=40))
    assert len(list(decontam.window_blocks(items_of(spark, items)))) > 2
    parts = {r["doc_id"]: r["found"] for r in decontam.contamination(rows, items_of(spark, items)).collect()}
    for doc_id, found in whole.items():
        assert (parts[doc_id]["n_words"], parts[doc_id]["n_hit"], parts[doc_id]["items"]) == (
            found["n_words"], found["n_hit"], found["items"])


def test_clean_keeps_other_rows_and_columns(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a b c"), (2, "x y"), (2, "x y"), (3, None)]).withColumn("found", F.lit("mine"))
    kept = decontam.clean(docs, items_of(spark, [(1, "B c")]))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["found"]) for r in kept.collect()) == [(2, "mine"), (2, "mine"), (3, "mine")]


def test_empty_tables(spark, docs_of):
    items = items_of(spark, [])
    assert decontam.report(docs_of([]), items).count() == 0
    row = decontam.report(docs_of([(1, "a b")]), items).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


def test_many_benchmarks_in_one_session(spark, docs_of):
    """Each is searched with its own automaton, whatever became of the last one's memory."""
    import gc

    words = [[f"b{i}w{k}" for k in range(12)] for i in range(40)]
    docs = docs_of([(i, f"x {' '.join(own)} y") for i, own in enumerate(words)]).coalesce(1).cache()
    for i, own in enumerate(words):
        found = decontam.report(docs, items_of(spark, [(i, " ".join(own))])).where("contaminated").collect()
        assert [(r["doc_id"], r["n_hit"]) for r in found] == [(i, 12)]
        gc.collect()
    docs.unpersist()


def test_blocks_are_named_by_content_and_built_once(monkeypatch):
    built = []

    class Held:
        def __init__(self, block):
            self.block = block

        @property
        def value(self):
            built.append(self.block)
            return self.block

    blocks = [{f" w{i} ": [str(i)]} for i in range(decontam.PASS_BLOCKS)]
    digests = [decontam.block_digest(b) for b in blocks]
    assert len(set(digests)) == len(digests) and decontam.block_digest(dict(blocks[0])) == digests[0]
    assert decontam.block_digest({" w0 ": ["1"]}) != digests[0]
    decontam._AUTOMATA.clear()
    for _ in range(20):
        for block, digest in zip(blocks, digests):
            assert decontam.scan(next(iter(block)).encode(), decontam._automaton(digest, Held(block)))[1] == 1
    assert built == blocks
    decontam._automaton("one more", Held({" z ": ["9"]}))
    assert len(decontam._AUTOMATA) == decontam.PASS_BLOCKS and digests[0] not in decontam._AUTOMATA
    decontam._AUTOMATA.clear()


def test_more_blocks_than_a_pass_takes(spark, docs_of, monkeypatch):
    docs, items = random_case()
    cut = decontam.window_blocks
    monkeypatch.setattr(decontam, "window_blocks", lambda items: cut(items, chars=1))
    assert sum(1 for _ in decontam.window_blocks(items_of(spark, items))) > 2 * decontam.PASS_BLOCKS
    got = decontam.report(docs_of(docs), items_of(spark, items)).collect()
    own = lambda r: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
    assert sorted((r["doc_id"], *own(r)) for r in got) == sorted((i, *brute(t, items)) for i, t in docs)
