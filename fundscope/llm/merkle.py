"""Document fingerprints (3): a Merkle tree over sections, paragraphs and pieces.

A text's lines are its paragraphs; every run of non-blank lines up to and with
the blank lines after it, and at most ``SECTION_LINES`` lines, is a section.  A
paragraph's leaves are its sentences, cut further into pieces of at most
``PIECE_CHARS`` characters (fewer at the text's head), so that an edit inside a long paragraph changes few
leaves.  Leaves cover every character.  Every inner node hashes its children.

A fingerprint is ``root:section/section/...`` where a section is
``paragraph.paragraph...`` and a paragraph is its leaves, 8 hex digits each
(the root is made from the whole 64-bit hashes).  Equal roots mean equal texts; ``differing`` goes down only where inner hashes
differ and names the paragraphs; ``likeness`` is the share of leaves that two
fingerprints have in common (twice the common leaves over all leaves, leaves
counted as often as they occur).

Defined cases: a null text is the empty text, whose tree is a root without
leaves; two empty texts have likeness 1, an empty and another text 0; rows
that repeat an id follow one another in the order of their texts; a null id
sorts first.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 48
#: The first HEAD_CHARS of a text have smaller pieces, so that short texts have several leaves too.
FINE_CHARS = 12
HEAD_CHARS = 256
SECTION_LINES = 16
#: Rows of a partition that the neighbour search aims at.
ROWS_PER_BUCKET = 500
MAX_BUCKETS = 100_000

_PIECE = re.compile(r"[^.!?]{1,%d}[.!?]*\s?|[.!?]+\s?" % PIECE_CHARS)
_FINE = re.compile(r"[^.!?]{1,%d}[.!?]*\s?|[.!?]+\s?" % FINE_CHARS)
_LINE = re.compile(r"[^\n]*\n|[^\n]+$")

_hash = xxhash.xxh3_64_intdigest


def _node(children: list[str]) -> str:
    return "%016x" % _hash("|".join(children).encode())


def _paragraph(line: str, fine: int) -> tuple[str, str]:
    """(hash over the 64-bit leaves, leaves cut to 32 bits) of a paragraph."""
    pieces = _FINE.findall(line[:fine]) + _PIECE.findall(line[fine:]) if fine > 0 else _PIECE.findall(line)
    leaves = np.array([_hash(p.encode()) for p in pieces], ">u8")
    return "%016x" % _hash(leaves.tobytes()), (leaves & 0xFFFFFFFF).astype(">u4").tobytes().hex()


def _sections(text: str) -> list[list[tuple[str, str]]]:
    out: list[list[tuple[str, str]]] = []
    blank, size, fine = False, SECTION_LINES, HEAD_CHARS
    for line in _LINE.findall(text):
        empty = not line.strip()
        if size == SECTION_LINES or blank and not empty:
            out.append([])
            size = 0
        out[-1].append(_paragraph(line, fine))
        blank, size, fine = empty, size + 1, fine - len(line)
    return out


def fingerprint(text: str | None) -> str:
    sections = _sections(text or "")
    root = _node([_node([node for node, _ in s]) for s in sections])
    return root + ":" + "/".join(".".join(leaves for _, leaves in s) for s in sections)


def _leaf_counts(mark: str) -> Counter:
    body = mark[17:].replace("/", "").replace(".", "")
    return Counter([body[i : i + 8] for i in range(0, len(body), 8)])


def likeness(one: str, other: str) -> float:
    """0 (nothing in common) to 1 (equal roots)."""
    if one[:16] == other[:16]:
        return 1.0
    a, b = _leaf_counts(one), _leaf_counts(other)
    common = sum((a & b).values())
    return 2.0 * common / (a.total() + b.total())


def differing(one: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) places whose hashes differ; nothing for equal roots."""
    if one[:16] == other[:16]:
        return []
    places = []
    a, b = ([s.split(".") for s in x[17:].split("/")] if len(x) > 17 else [] for x in (one, other))
    for i in range(max(len(a), len(b))):
        left, right = (x[i] if i < len(x) else [] for x in (a, b))
        if _node(left) != _node(right):
            for k in range(max(len(left), len(right))):
                if left[k : k + 1] != right[k : k + 1]:
                    places.append((i, k))
    return places


def edited(text: str, following: str) -> str:
    """The last half replaced by the first as many characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, guest, text): rows dealt to id ranges, each range with its follower as a guest.

    Ranges come from quantiles of the ids alone.  A range's first document is
    sent to the range before it too (the overall first to the last range), so
    that each range can be read on its own, and texts are shuffled once.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), "doc_id", "text")
    ids = rows.select("id")
    n = ids.count()
    want = min(MAX_BUCKETS, max(1, n // ROWS_PER_BUCKET))
    spark = docs.sparkSession
    cuts = sorted(set(ids.approxQuantile("id", [i / want for i in range(1, want)], 0.1 / want))) if want > 1 else []
    bounds = [int(c) for c in cuts]
    bucket = F.lit(0)
    if bounds:
        held = spark.sparkContext.broadcast(bounds)

        @F.arrow_udf("int")
        def bucket_of(values: pa.Array) -> pa.Array:
            return pa.array(np.searchsorted(np.array(held.value), values.to_numpy(), side="right").astype(np.int32))

        bucket = bucket_of(F.col("id"))
    heads = {r["b"]: r["id"] for r in ids.withColumn("b", bucket).groupBy("b").agg(F.min("id").alias("id")).collect()}
    order = sorted(heads)
    before = {heads[b]: order[i - 1] for i, b in enumerate(order)}
    known = spark.createDataFrame(list(before.items()), "first long, goes int").coalesce(1)  # one row per bucket
    dealt = rows.withColumn("bucket", bucket).join(F.broadcast(known), F.col("id") == F.col("first"), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("goes").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("goes").isNull(), F.array(own)).otherwise(F.array(own, guest))
    dealt = dealt.withColumn("to", F.explode(places)).select("to.bucket", "to.guest", "id", "doc_id", "text")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", "id", "text").drop("id")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_edits long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_edits", pa.int64()),
])


def _compare(doc_id, text: str, mark: str, following: str, next_mark: str) -> tuple:
    changed = edited(text, following)
    changed_mark = fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    places = len(differing(mark, changed_mark))
    return doc_id, len(text), digest, mark, changed_mark, likeness(mark, changed_mark), likeness(mark, next_mark), places


def _compare_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (bucket, guest, doc_id, text) in order; each own row is compared with the row after it."""
    held = None
    for batch in batches:
        rows = []
        for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            if held and held[0] != bucket:
                held = None
            if guest and held is None:
                continue  # a further row of the follower
            mark = fingerprint(text)
            if held:
                rows.append(_compare(held[1], held[2], held[3], text, mark))
            held = None if guest else (bucket, doc_id, text, mark)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def report(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint, the edited text's, and how like they and the next document's are."""
    return with_next(docs).mapInArrow(_compare_batches, SCHEMA)


def fingerprints(docs: DataFrame, as_col: str = "fingerprint", text_col: str = "text") -> DataFrame:
    """``docs`` with their fingerprints."""

    @F.arrow_udf("string")
    def marks(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t) for t in texts.to_pylist()], pa.string())

    return docs.withColumn(as_col, marks(F.col(text_col)))
