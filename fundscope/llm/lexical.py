"""Ranked lexical search (13): item terms against all documents by dense blocked multiplication.

Terms are the maximal matches of ``TERM`` in the whole text, A-Z lower-cased.
With N documents that have a term, L terms in all and n in one document, df
documents holding a term and tf its occurrences in one, a term weighs
w = floor(1000 ln((2N+2) / (2df+1))) and a document gets from it
w * ((10^9 tf) div (1000 tf + 20 m)), m = 100 - 50 + ((50 n N) div L).  A score
is the sum over the item's terms, once each; each item keeps its ``TOP`` best
documents with a score above 0, ties by ascending doc_id.

The items are the stated query set.  They are cut into blocks of at most
``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms (and one item more), so what
the driver holds and a task gets is bounded however many items there are; each
block passes over the documents once.  A task first reduces its texts to the
counts of the block's terms (stored), then multiplies tiles of documents x
terms (impacts) with tiles of terms x items (weights) in float64.  A tile is so
narrow that no partial sum reaches 2^53, so the products are exact; tiles are
added up as 64-bit integers.  Each task keeps its best documents of each item,
and two rounds of ranking (by parts of the documents, then by item) bound what
one task ranks.

Defined cases: null, empty and termless texts count in neither N nor L and are
never found; rows that repeat an id are documents of their own, each ranked; a
null doc_id comes last among equal scores; rows of one item_id are one item
(their terms once each), items without an id are ignored, items without terms
find nothing; empty tables give an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.bytewords import Lookup, byte_table, portions
from fundscope.llm.common import LOWER, UPPER, stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
BLOCK_ITEMS = 512
BLOCK_TERMS = 16_384
TILE_DOCUMENTS = 1024
TILE_TERMS = 2048
#: Parts of the documents that are ranked on their own first.
PARTS = 64
#: No impact reaches this: 10^9 tf div (1000 tf + 20 m).
IMPACT_BOUND = 1_000_000
#: Candidates that a task holds before it cuts them to the best of each item.
HELD = 2_000_000

_TABLE = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


@dataclass
class Block:
    """Items (ids as text) and their distinct terms; ``pairs`` holds (item, term) numbers."""

    items: list[str]
    terms: list[bytes]
    pairs: np.ndarray


def terms_of(text: str | None) -> list[bytes]:
    """The distinct terms of one text."""
    return sorted({w.word(i) for w in portions(pa.array([text], pa.string()), _TABLE) for i in range(len(w.starts))})


def blocks(items: DataFrame, most_items: int = BLOCK_ITEMS, most_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks, in the order of their ids; the driver holds one block at a time."""
    rows = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    ids: list[str] = []
    terms: dict[bytes, int] = {}
    pairs: set[tuple[int, int]] = set()

    def done() -> Block:
        return Block(ids, list(terms), np.array(sorted(pairs), np.int64).reshape(-1, 2))

    for row in rows.orderBy("item_id").toLocalIterator():
        if not ids or ids[-1] != row["item_id"]:
            if len(ids) >= most_items or len(terms) >= most_terms:
                yield done()
                ids, terms, pairs = [], {}, set()
            ids.append(row["item_id"])
        pairs.update((len(ids) - 1, terms.setdefault(t, len(terms))) for t in terms_of(row["text"]))
    if ids:
        yield done()


def _count_batches(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lookup(block.terms, _TABLE)
        size = len(block.terms)
        for batch in batches:
            for words in portions(batch.column(1), _TABLE):
                number, _ = known.find(words)
                at = np.flatnonzero(number >= 0)
                term = number[at]
                text = np.searchsorted(words.bounds, at, side="right") - 1
                pairs, tf = np.unique(text * size + term, return_counts=True)
                offsets = pa.array(np.searchsorted(pairs, np.arange(words.texts + 1) * size), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (pairs % size, tf)]
                n = pa.array(np.diff(words.bounds), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(words.first, words.texts), n, *lists], names=["doc_id", "n", "terms", "tfs"]
                )

    return run


def _df_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(df[there])], names=["term", "df"])

    return run


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """m of each document, exact also where 50 n N passes 64 bits."""
    if int(n.max(initial=0)) * 50 * n_documents < 1 << 62:
        return 50 + 50 * n * n_documents // n_terms
    return np.array([50 + 50 * int(x) * n_documents // n_terms for x in n.tolist()], np.int64)


def tile_width(weights: np.ndarray) -> int:
    """Terms in a tile, so that its sums stay below 2^53."""
    return max(1, min(TILE_TERMS, ((1 << 53) - 1) // (IMPACT_BOUND * max(1, int(weights.max(initial=0))))))


def best(item: np.ndarray, doc: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Indices of the ``top`` best documents of each item; ``doc`` is the order of equal scores."""
    order = np.lexsort((doc, -score, item))
    ranked = item[order]
    place = np.arange(len(order)) - np.searchsorted(ranked, ranked, side="left")
    return order[place < top]


def _score_batches(block: Block, weights: np.ndarray, n_documents: int, n_terms: int, top: int):
    names = ["item", "doc_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = tile_width(weights)
        tiles = []
        for low in range(0, len(weights), width):
            tile = np.zeros((min(width, len(weights) - low), len(block.items)))
            mine = block.pairs[(block.pairs[:, 1] >= low) & (block.pairs[:, 1] < low + width)]
            tile[mine[:, 1] - low, mine[:, 0]] = weights[mine[:, 1]]
            tiles.append(tile)
        least = np.zeros(len(block.items), np.int64)  # a score below is not among the best
        held: list[tuple[np.ndarray, ...]] = []

        def cut() -> tuple[np.ndarray, ...]:
            item, doc, score = (np.concatenate(x) for x in zip(*held))
            kept = best(item, doc, score, top)
            item, doc, score = item[kept], doc[kept], score[kept]
            full = np.bincount(item, minlength=len(least)) >= top
            low = np.full(len(least), np.iinfo(np.int64).max)
            np.minimum.at(low, item, score)
            least[full] = low[full]
            held[:] = [(item, doc, score)]
            return held[0]

        for whole in batches:
            for at in range(0, whole.num_rows, TILE_DOCUMENTS):
                batch = whole.slice(at, TILE_DOCUMENTS)
                doc = batch.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
                m = lengths(batch.column(1).to_numpy(), n_documents, max(1, n_terms))
                lists = batch.column(2)
                row = np.repeat(np.arange(len(doc)), lists.value_lengths().to_numpy())
                term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
                scores = np.zeros((len(doc), len(block.items)), np.int64)
                for i, tile in enumerate(tiles):
                    mine = slice(None) if len(tiles) == 1 else (term >= i * width) & (term < (i + 1) * width)
                    dense = np.zeros((len(doc), len(tile)))
                    dense[row[mine], term[mine] - i * width] = impact[mine]
                    scores += (dense @ tile).astype(np.int64)
                d, item = np.nonzero((scores > 0) & (scores >= least))
                held.append((item, doc[d], scores[d, item]))
                if sum(len(x[0]) for x in held) > HELD or len(held) == 1:
                    cut()
        if held:
            item, doc, score = cut()
            unknown = doc == np.iinfo(np.int64).max
            columns = [pa.array(item, pa.int32()), pa.array(doc, mask=unknown), pa.array(score)]
            for i in range(0, len(item), 50_000):
                yield pa.RecordBatch.from_arrays([c.slice(i, 50_000) for c in columns], names=names)

    return run


def _ranked(found: DataFrame, top: int, *keys) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = rows.mapInArrow(_count_batches(block), "doc_id long, n long, terms array<int>, tfs array<int>")
    counts = stored(counts, "lexical-counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = counts.select("terms").mapInArrow(_df_batches(len(block.terms)), "term int, df long")
    weights = np.zeros(len(block.terms), np.int64)
    for r in df.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most a block's terms
        weights[r["term"]] = weight(total["docs"], r["df"])
    found = counts.mapInArrow(
        _score_batches(block, weights, total["docs"], total["terms"], top), "item int, doc_id long, score long"
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    ranked = _ranked(_ranked(found, top, "item", part).drop("rank"), top, "item")
    names = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id string")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of each item, written once."""
    kind = items.schema["item_id"].dataType
    found = None
    for block in blocks(items):
        if block.terms:
            part = stored(_search_block(docs, block, top), "lexical-ranks")
            found = part if found is None else found.union(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id string, rank int, doc_id long, score long")
    return found.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")


#: DuckDB twin of the query: plain joins of items and documents on their terms.
ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '%(upper)s', '%(lower)s'), '%(term)s') AS w
  FROM documents WHERE text IS NOT NULL
),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '%(upper)s', '%(lower)s'), '%(term)s')) AS term
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
),
tfs AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term, n_docs
),
impacts AS (
  SELECT f.r, f.term, g.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * len(d.w) * t.n_docs) // t.n_terms))) AS score
  FROM tfs f JOIN weights g USING (term) JOIN docs d USING (r), total t
),
scores AS (SELECT q.item_id, i.r, CAST(sum(i.score) AS BIGINT) AS score FROM wanted q JOIN impacts i USING (term) GROUP BY ALL),
ranked AS (
  SELECT s.item_id, CAST(row_number() OVER (PARTITION BY s.item_id ORDER BY s.score DESC, d.doc_id) AS INTEGER) AS rank, d.doc_id, s.score
  FROM scores s JOIN docs d USING (r) WHERE s.score > 0
)
SELECT * FROM ranked WHERE rank <= %(top)d
""" % {"upper": UPPER, "lower": LOWER, "term": TERM, "top": TOP}
