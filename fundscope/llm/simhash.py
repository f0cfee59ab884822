"""SimHash near-duplicates (5): fingerprints linked through BK-trees.

Words are ``[^ \\t-\\r]+`` of the text with A-Z lower-cased; shingles are four
words (a shorter text is one shingle, no words give fingerprint 0).  A bit of
the fingerprint is 1 if it is set in more than half of the shingles' XXH64
(seed 42).  Fingerprints at most ``max_distance`` bits apart are linked, and
documents reachable over links form a component.

Search.  Two fingerprints that differ in at most r bits agree on at least
b - r of b bit blocks, so every choice of b - r blocks is one family of shards
and no link is lost.  Each shard holds a BK-tree (children keyed by their
integer Hamming distance to the parent); a search follows only the edges
within the radius.  Trees stay with their shard instead of being broadcast to
all tasks: a broadcast of every tree grows with the corpus.  A shard over
``SHARD_ROWS`` is split into chunks, and each pair of chunks is one task's
tree and queries.  A task returns a spanning forest of the links it found,
which has fewer rows than members, never all pairs.

Defined cases: null and empty texts have fingerprint 0 and are linked like any
other; rows that repeat id and text are one document; rows without an id are
linked too, and a component without any id has a null ``component_id``; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import ASCII_LOWER, binary_list, row_key, stored
from fundscope.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: Members of a shard that one tree holds; larger shards are split into chunks.
SHARD_ROWS = 2048
#: Distinct fingerprints per shard that the choice of block count aims at.
SHARD_AIM = 4096
#: Shingles hashed at a time, which bounds memory for very long texts.
HASH_STEP = 1 << 16
#: Members of a tree node that are compared directly instead of being split further.
LEAF = 32

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, len(words))
    first, last = starts[: len(words) - k + 1], ends[k - 1 :]
    ones = np.zeros(64, np.int64)
    xxh64 = xxhash.xxh64_intdigest
    for at in range(0, len(first), HASH_STEP):
        pairs = zip(first[at : at + HASH_STEP].tolist(), last[at : at + HASH_STEP].tolist())
        hashes = np.array([xxh64(joined[a:b], SEED) for a, b in pairs], np.uint64)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(8, dtype=np.int64) * 256
        counts = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ _BITS).ravel()
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(first)).tolist()))


def _fingerprint_batches(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle_words) for t in binary_list(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "rid", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, rid, fp): rid names the text, fp is the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), "text")
    return rows.mapInArrow(_fingerprint_batches(shingle_words), "doc_id long, rid long, fp long")


class BKTree:
    """A BK-tree over distinct 64-bit fingerprints, searched with many queries at once."""

    def __init__(self, members: np.ndarray):
        self.leaf = self.root = None
        self.children: list[tuple[int, BKTree]] = []
        if len(members) <= LEAF:
            self.leaf = members
            return
        self.root, rest = members[0], members[1:]
        apart = np.bitwise_count(rest ^ self.root)
        order = np.argsort(apart, kind="stable")
        keys, at = np.unique(apart[order], return_index=True)
        for key, part in zip(keys.tolist(), np.split(rest[order], at[1:])):
            self.children.append((key, BKTree(part)))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (member, query) pairs at most ``radius`` bits apart."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        stack = [(self, queries)]
        while stack:
            node, asked = stack.pop()
            if node.leaf is not None:
                i, j = np.nonzero(np.bitwise_count(node.leaf[:, None] ^ asked[None, :]) <= radius)
                found.append((node.leaf[i], asked[j]))
                continue
            apart = np.bitwise_count(asked ^ node.root).astype(np.int16)
            near = asked[apart <= radius]
            found.append((np.full(len(near), node.root, np.uint64), near))
            for key, child in node.children:
                kept = asked[np.abs(apart - key) <= radius]
                if len(kept):
                    stack.append((child, kept))
        return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) edges that connect what the pairs connect, one per member at most."""
    nodes, index = np.unique(np.concatenate((left, right)), return_inverse=True)
    a, b = index[: len(left)], index[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def shard_links(members: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one chunk (one value of ``side``) or between two chunks of a shard."""
    first = side == side[0]
    tree, asked = members[first], members[~first]
    if first.all():
        asked = tree
    x, y = BKTree(tree).search(asked, radius)
    apart = x != y
    return forest(x[apart], y[apart])


def _link_batches(radius: int):
    names = ["u", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((4, 0), np.int64)

        def links(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not rows.shape[1]:
                return
            change = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(axis=0)) + 1
            out = []
            for a, b in zip(np.r_[0, change].tolist(), np.r_[change, rows.shape[1]].tolist()):
                if b - a > 1:
                    u, v = shard_links(rows[3, a:b].view(np.uint64), rows[2, a:b], radius)
                    if len(u):
                        out.append((u.view(np.int64), v.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=names)

        for batch in batches:
            rows = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.int64)
            rows = np.ascontiguousarray(np.concatenate((rest, rows), axis=1))
            last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1]) if rows.shape[1] else np.zeros(0, bool)
            yield from links(np.ascontiguousarray(rows[:, ~last]))
            rest = np.ascontiguousarray(rows[:, last])
        yield from links(rest)

    return run


def block_masks(blocks: int, radius: int) -> list[int]:
    """One 64-bit mask for every choice of ``blocks - radius`` of ``blocks`` bit blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(single, blocks - radius)]


def fingerprint_links(prints: DataFrame, max_distance: int = MAX_DISTANCE, blocks: int | None = None) -> DataFrame:
    """Spanning edges (u, v) of the links between the distinct ``fp`` of ``prints``.

    ``blocks`` (default: from the number of fingerprints) changes shard sizes
    and copies of a row, never the links.
    """
    if blocks is None:
        n, blocks = prints.count(), max_distance + 1
        while n >> (64 * (blocks - max_distance) // blocks) > SHARD_AIM and blocks < 2 * max_distance:
            blocks += 1
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, max_distance)]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("b", "mask"))
    keyed = keyed.select("fp", F.xxhash64("b", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"))
    hot = keyed.groupBy("shard").count().where(F.col("count") > SHARD_ROWS)
    hot = hot.select("shard", F.ceil(F.col("count") / F.lit(SHARD_ROWS)).cast("long").alias("chunks"))
    split = keyed.join(hot, "shard", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    split = split.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")
    tasks = split.select("shard", pair.alias("pair"), F.col("own").cast("long").alias("own"), "fp")
    tasks = tasks.repartition("shard", "pair").sortWithinPartitions("shard", "pair")
    return tasks.mapInArrow(_link_batches(max_distance), "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """(doc_id, rid, fp, component_id, keep) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links; ``keep`` marks
    the document that stands for its component (the smallest id, then rid).
    """
    rows = stored(fingerprints(docs, shingle_words), "simhash-prints")
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    prints = stored(rows.groupBy("fp").agg(F.min(who).alias("first")), "simhash-distinct")
    parts = connected_components(fingerprint_links(prints.select("fp"), max_distance), "simhash-stars")
    rooted = prints.join(parts, prints["fp"] == parts["node"], "left")
    rooted = rooted.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(heads, "root").select("fp", "head")
    kept = (F.col("rid") == F.col("head.rid")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
    return rows.join(named, "fp").select(
        "doc_id", "rid", "fp", F.col("head.doc_id").alias("component_id"), kept.alias("keep")
    )


def deduplicated(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with the same columns."""
    from pyspark.sql import Window

    kept = near_duplicates(docs, shingle_words, max_distance).where("keep")
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("rid").alias("__key")).distinct()
    keyed = docs.withColumn("__rid", row_key())
    match = keyed["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (keyed["__rid"] == kept["__key"])
    once = F.row_number().over(Window.partitionBy("__key", "__id").orderBy(F.lit(0)))
    return keyed.join(kept, match).withColumn("__nth", once).where("__nth = 1").select(*docs.columns)
