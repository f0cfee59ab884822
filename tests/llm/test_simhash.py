from __future__ import annotations

import random

import numpy as np
import xxhash

from fundscope.llm import simhash
from fundscope.llm.components import connected_components


def brute_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def expected(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (doc_id, _), r in zip(rows, roots):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)


def got(df):
    return sorted(((r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"]) for r in df.collect()), key=str)


def test_documents_equal_brute_force(spark, docs_of):
    rng = random.Random(2)
    words = ["Alpha", "be", "ça", "d", "eps", "zeta", "η"]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 3, 4, 40, 120]))] for _ in range(25)]
    rows = []
    for i, own in enumerate(base):
        for copy in range(3):
            changed = list(own)
            if copy == 2:
                changed[-1] = "new"
            rows.append((3 * i + copy, "\n ".join(changed)))
    rows += [(500, None), (501, ""), (502, "  "), (None, "".join(base[0])), (None, None), (3, rows[3][1]), (600, "long word " * 40_000)]
    assert got(simhash.near_duplicates(docs_of(rows))) == expected(rows)


def test_rows_without_any_id(spark, docs_of):
    rows = [(None, "one two three four five"), (None, "one two three four five")]
    found = simhash.near_duplicates(docs_of(rows)).collect()
    assert [(r["component_id"], r["keep"]) for r in found] == [(None, True)] * 2
    assert simhash.deduplicated(docs_of(rows)).count() == 1


def prints_near(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = rng.getrandbits(64) if not out or rng.random() < 0.4 else rng.choice(out)
        for _ in range(rng.choice([0, 1, 3, 4, 5, 6])):
            at ^= 1 << rng.randrange(64)
        out.append(at)
    return sorted(set(out))


def roots_of(spark, prints, **options):
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    roots = connected_components(simhash.fingerprint_links(frame, **options)).collect()
    return {r["node"] % (1 << 64): r["root"] for r in roots}


def same_parts(prints, roots):
    brute = brute_components(prints)
    label = {}
    for p, r in zip(prints, brute):
        label.setdefault(r, set()).add(roots.get(p, ("alone", p)))
    assert all(len(x) == 1 for x in label.values())
    assert len({next(iter(x)) for x in label.values()}) == len(label)


def test_links_do_not_depend_on_blocks_or_splits(spark, monkeypatch):
    prints = prints_near(400)
    for blocks in (5, 6, 7):
        same_parts(prints, roots_of(spark, prints, blocks=blocks))
    monkeypatch.setattr(simhash, "SHARD_ROWS", 3)
    same_parts(prints, roots_of(spark, prints))


def test_tree_search_equals_brute_force():
    members = np.array(prints_near(500, 4), np.uint64)
    queries = np.array(prints_near(120, 5) + members[:60].tolist(), np.uint64)
    x, y = simhash.BKTree(members).search(queries, 4)
    want = {(int(a), int(b)) for a in members for b in queries if int(a ^ b).bit_count() <= 4}
    assert set(zip(x.tolist(), y.tolist())) == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_deduplicated_keeps_one_of_each_group(spark, docs_of):
    from pyspark.sql import functions as F

    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (9, "other words are here"), (5, None), (6, "")]
    docs = docs_of(rows).withColumn("fp", F.lit("x")).withColumn("keep", F.lit(False)).withColumn("root", F.lit(0))
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 9]
    assert simhash.deduplicated(docs_of([])).count() == 0
