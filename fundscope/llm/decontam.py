"""Benchmark decontamination (1): one Aho-Corasick automaton over normalised items.

A-Z are lower-cased and words are maximal runs of digits, a-z and characters
beyond ASCII.  A window is 10 consecutive words of an item; an item with fewer
words, but not none, is one window.  A document word inside any occurrence of
a window is hit.  The automaton holds every window as ``" w1 w2 ... "`` and
reads each normalised text once; spans are mapped back to the original text.

The benchmark is the stated query set.  Windows are dealt to blocks of at most
``BLOCK_CHARS`` characters and each block has its own automaton, named by a
digest of its content and built once per worker.  One pass searches at most
``PASS_BLOCKS`` blocks, which is what a worker keeps, so what a task holds is
bounded however large the benchmark is; a benchmark beyond that takes further
passes, each written before the next (one pass, for common benchmark sizes).

Defined cases: null and empty texts have no words and are clean; items with
null or wordless text have no windows; items without an id are ignored; equal
items each count; an empty benchmark leaves all documents clean; documents
without an id are checked like any other.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundscope.llm.common import LOWER, UPPER, binary_list, stored

WINDOW_WORDS = 10
#: Characters of windows per automaton (a node is some 50 bytes, so about 100 MB at most).
BLOCK_CHARS = 2_000_000
#: Automata that one pass uses and a worker keeps.
PASS_BLOCKS = 4

#: A-Z to a-z; ASCII that is no word character to a space; the rest stays.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: The same words in a text whose capitals are still there.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
])


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def item_windows(text: bytes | None, size: int = WINDOW_WORDS) -> list[str]:
    """The windows of one item, each with a space before and after every word."""
    own = words(text)
    spans = [own[i : i + size] for i in range(max(1, len(own) - size + 1))] if own else []
    return [" " + b" ".join(x).decode() + " " for x in spans]


def window_blocks(items: DataFrame, size: int = WINDOW_WORDS, chars: int = BLOCK_CHARS) -> Iterator[dict[str, list[str]]]:
    """Blocks {window: ids of its items}, each of at most ``chars`` characters and one item more."""
    rows = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    block: dict[str, set[str]] = {}
    held = 0
    for row in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        for window in item_windows(row["text"].encode() if row["text"] is not None else None, size):
            held += len(window) if window not in block else 0
            block.setdefault(window, set()).add(row["item_id"])
        if held > chars:
            yield {w: sorted(x) for w, x in block.items()}
            block, held = {}, 0
    if block:
        yield {w: sorted(x) for w, x in block.items()}


def block_digest(block: dict[str, list[str]]) -> str:
    """Names a block by its windows and items."""
    of = hashlib.sha256()
    for window in sorted(block):
        of.update(repr((window, block[window])).encode())
    return of.hexdigest()


#: The worker's automata by digest, the least recently used first.
_AUTOMATA: OrderedDict[str, ahocorasick.Automaton] = OrderedDict()


def _automaton(digest: str, block) -> ahocorasick.Automaton:
    """The worker's automaton of a broadcast block; ``PASS_BLOCKS`` of them are kept."""
    if digest not in _AUTOMATA:
        while len(_AUTOMATA) >= PASS_BLOCKS:
            _AUTOMATA.popitem(last=False)
        made = ahocorasick.Automaton()
        for window, ids in block.value.items():
            made.add_word(window, (len(window), window.count(" ") - 1, ids))
        made.make_automaton()
        _AUTOMATA[digest] = made
    _AUTOMATA.move_to_end(digest)
    return _AUTOMATA[digest]


def scan(text: bytes | None, automaton) -> tuple[int, int, list[str], list[list[int]]]:
    """(words, words hit, item ids, [start, end) spans of the original text)."""
    own = words(text)
    if not own:
        return 0, 0, [], []
    joined = " " + b" ".join(own).decode() + " "
    matches = list(automaton.iter(joined)) if len(automaton) else []
    if not matches:
        return len(own), 0, [], []
    before = np.cumsum(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
    edge = np.zeros(len(own) + 1, np.int64)
    items: set[str] = set()
    for end, (_, n, ids) in matches:
        last = int(before[end]) - 1  # words whose closing space is at or before `end`
        edge[last - n] += 1
        edge[last] -= 1
        items.update(ids)
    hit = np.cumsum(edge[:-1]) > 0
    steps = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    at = [m.span() for m in _WORD.finditer(text.decode())]
    spans = [[at[a][0], at[b - 1][1]] for a, b in steps.reshape(-1, 2).tolist()]
    return len(own), int(hit.sum()), sorted(items), spans


def _scanner(spark, block: dict[str, list[str]]):
    held, digest = spark.sparkContext.broadcast(block), block_digest(block)

    @F.arrow_udf(FOUND)
    def found(texts: pa.Array) -> pa.Array:
        automaton = _automaton(digest, held)
        rows = [scan(t, automaton) for t in binary_list(texts)]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FOUND.names)

    return found


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", as_col: str = "found") -> DataFrame:
    """``docs`` with a struct column (n_words, n_hit, items, spans).

    With several blocks, spans of the blocks are merged before counting, in a
    second Arrow step over the blocks' spans.
    """
    spark = docs.sparkSession
    searched, names = docs, []
    # a block leaves the driver with its broadcast: the driver holds one at a time
    for i, block in enumerate(window_blocks(items)):
        if i and i % PASS_BLOCKS == 0:
            searched = stored(searched, "decontam-pass")
        names.append(f"__{as_col}_block_{i}")
        searched = searched.withColumn(names[-1], _scanner(spark, block)(F.col(text_col)))
    if not names:
        return docs.withColumn(as_col, _scanner(spark, {})(F.col(text_col)))
    if len(names) == 1:
        return searched.select(*docs.columns, F.col(names[0]).alias(as_col))

    @F.arrow_udf(FOUND)
    def merged(texts: pa.Array, parts: pa.Array) -> pa.Array:
        rows = []
        for text, found in zip(binary_list(texts), parts.to_pylist()):
            joined: list[list[int]] = []
            for a, b in sorted(s for p in found for s in p["spans"]):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            n_hit, place = 0, 0
            for a, _ in (m.span() for m in _WORD.finditer(text.decode())) if joined else ():
                while place < len(joined) and joined[place][1] <= a:
                    place += 1
                n_hit += place < len(joined) and joined[place][0] <= a
            ids = sorted({i for p in found for i in p["items"]})
            rows.append((found[0]["n_words"], n_hit, ids, joined))
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], FOUND.names)

    return searched.withColumn(as_col, merged(F.col(text_col), F.array(*names))).drop(*names)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, number and digest of the items found, spans."""
    found = contamination(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit, with the same columns."""
    found = contamination(docs, items, as_col="__found")
    return found.where("__found.n_hit = 0").select(*docs.columns)


#: DuckDB twin of the query: windows of each length are joined as joined words.
ORACLE_SQL = """
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, '%(upper)s', '%(lower)s'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), %(size)d) AS k,
         array_to_string(w[i:i + least(len(w), %(size)d) - 1], ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - %(size)d + 1, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '%(upper)s', '%(lower)s'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
),
places AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS key
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
),
matches AS (SELECT p.r, p.i, p.k, x.item_id FROM places p JOIN windows x ON p.k = x.k AND p.key = x.key),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM matches) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS joined
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM matches) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.joined, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.r = h.r LEFT JOIN ids i ON d.r = i.r
""" % {"upper": UPPER, "lower": LOWER, "size": WINDOW_WORDS}
