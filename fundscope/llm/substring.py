"""Substring dedup (11): repeated word runs by winnowed anchors, extended both ways.

Words are ``[^ \\t-\\r]+`` of the whole text, unchanged.  A window is
``MIN_WORDS`` consecutive words of one document.  Every word that is covered
by a window whose word sequence also starts earlier (smaller doc_id, or the
same document and an earlier start) is removed; windows are judged on the
input.

Seed.  Of the ``ANCHOR_WORDS``-grams inside each window the one with the
smallest hash (the rightmost of equals) is its anchor, so equal windows have
equal anchors at equal offsets and no repeat is lost.  Consecutive windows
with one anchor are one occurrence of it: some nine words of text bring one
row instead of one per window.

Extend.  An occurrence reaches from the first word of its first window to the
last word of its last.  Occurrences of an anchor that agree on all of that
(the extent) have the same windows: all but the earliest are repeats.  Where
an anchor stands in different extents, the match ends inside them; only the
earliest occurrence of each such extent is compared window by window.
Overlapping windows join to maximal repeats when they are cut out.

Anchors are counted after combining rows within a task, joins have one row a
key on their small side, so a hot anchor is split by AQE's skew join, and all
firsts are minima that are combined map-side.  Runs are compared by two
64-bit hashes of their words (anchor and extent, or anchor and window).

Defined cases: null and empty texts have no words, a null text stays null;
texts shorter than a window lose nothing; rows that repeat id and text are one
document; texts that share an id are ordered by their hash; a null id sorts
first; an empty table gives an empty result; other columns are passed through
by ``without_repeats``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.bytewords import Rolling, Words, byte_table, mixed, portions
from fundscope.llm.common import binary_list, row_key, stored

MIN_WORDS = 20
ANCHOR_WORDS = 5
#: Rows that a task combines before it sends them.
COMBINE_ROWS = 1_000_000
#: Bytes of texts whose words a worker holds as numbers, some twenty times their bytes; and rows that it cuts together.
#: A task has two workers at a time, and an executor two for each of its cores.
HELD_BYTES = 400_000
CUT_ROWS = 500

_TABLE = byte_table(b" \t\n\x0b\f\r", lower=False)
_GRAM, _RUN = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_PLACE = ["doc_id", "rid", "start"]
_OCCURRENCE = "anchor long, extent long, doc_id long, rid long, start int, m int"


def rightmost_min(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (the last of equals) of every ``width`` neighbours."""
    low, at, span = values, np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        later = low[step:] <= low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        span += step
    return at


def occurrences(words: Words, size: int = MIN_WORDS, gram: int = ANCHOR_WORDS) -> tuple[np.ndarray, ...]:
    """(anchor, extent, text number, start within the text, windows) of each occurrence."""
    n = len(words.starts)
    if n < size:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    hashes = words.hashes()
    grams = Rolling(hashes, _GRAM).of(np.arange(n - gram + 1), gram)
    anchor_at = rightmost_min(grams, size - gram + 1)
    text = words.text_of_word()
    start = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])  # windows within one text
    anchor_at = anchor_at[start]
    new = np.ones(len(start), bool)
    new[1:] = anchor_at[1:] != anchor_at[:-1]
    head = np.flatnonzero(new)
    m = np.diff(np.append(head, len(start)))
    first, at = start[head], anchor_at[head]
    run = Rolling(hashes, _RUN).of(first, m + (size - 1))
    extent = mixed(run + (at - first).astype(np.uint64))
    return grams[at], extent, text[first], first - words.bounds[text[first]], m


def _occurrence_batches(size: int, gram: int):
    names = ["anchor", "extent", "doc_id", "rid", "start", "m"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in portions(batch.column(2), _TABLE, HELD_BYTES):
                anchor, extent, text, start, m = occurrences(words, size, gram)
                if not len(anchor):
                    continue
                row = pa.array(text + words.first)
                columns = [pa.array(anchor.view(np.int64)), pa.array(extent.view(np.int64))]
                columns += [batch.column(0).take(row), batch.column(1).take(row)]
                columns += [pa.array(start, pa.int32()), pa.array(m, pa.int32())]
                for i in range(0, len(row), 50_000):
                    yield pa.RecordBatch.from_arrays([c.slice(i, 50_000) for c in columns], names=names)

    return run


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per anchor and extent with its first place and count, for ``COMBINE_ROWS`` rows at a time."""
    held: list[pa.RecordBatch] = []

    def out() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        keys = [table.column(c).to_numpy() for c in ("anchor", "extent")]
        order = np.lexsort(keys[::-1])
        same = np.ones(len(order), bool)
        same[1:] = np.logical_or(*(k[order][1:] != k[order][:-1] for k in keys))
        head = np.flatnonzero(same)
        count = np.diff(np.append(head, len(order)))
        often = np.repeat(count > 1, count)
        pick = order[head]
        if often.any():  # the first place among the rows of a key that repeats here
            rows = order[often]
            part = table.select(["anchor", "extent", *_PLACE]).take(pa.array(rows)).append_column("row", pa.array(rows))
            by = [(c, "ascending") for c in ("anchor", "extent", *_PLACE)]
            ranked = part.take(pc.sort_indices(part, by, null_placement="at_start"))
            a, e = (ranked.column(c).to_numpy() for c in ("anchor", "extent"))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (e[1:] != e[:-1])
            pick[count > 1] = ranked.column("row").to_numpy()[new]
        held.clear()
        for i in range(0, len(pick), 50_000):  # taken as they are sent
            some = table.select(["anchor", "extent", *_PLACE]).take(pa.array(pick[i : i + 50_000]))
            yield from some.append_column("n", pa.array(count[i : i + 50_000])).combine_chunks().to_batches()

    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= COMBINE_ROWS:
            yield from out()
            n = 0
    if held:
        yield from out()


def _window_batches(size: int):
    """(anchor, window, doc_id, rid, start) of the given starts of each text."""
    names = ["anchor", "window", *_PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(3)
            flat = spans.flatten()
            lengths = np.diff(np.frombuffer(spans.buffers()[1], np.int32)[spans.offset : spans.offset + len(spans) + 1])
            owner = np.repeat(np.arange(len(spans)), lengths)
            anchor, start, m = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for words in portions(batch.column(2), _TABLE, HELD_BYTES):
                mine = (owner >= words.first) & (owner < words.first + words.texts)
                if not mine.any():
                    continue
                own, k = owner[mine] - words.first, m[mine]
                at = np.repeat(start[mine], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                text = np.repeat(own, k)
                window = Rolling(words.hashes(), _RUN).of(words.bounds[text] + at, size)
                row = pa.array(text + words.first)
                columns = [pa.array(np.repeat(anchor[mine], k)), pa.array(window.view(np.int64))]
                columns += [batch.column(0).take(row), batch.column(1).take(row), pa.array(at, pa.int32())]
                for i in range(0, len(row), 50_000):
                    yield pa.RecordBatch.from_arrays([c.slice(i, 50_000) for c in columns], names=names)

    return run


def _first(df: DataFrame, *keys: str) -> DataFrame:
    """The first place of each key that occurs more than once."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("n"))
    return first.where("n > 1").drop("n")


def repeats(docs: DataFrame, size: int = MIN_WORDS, gram: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, rid, start, m): runs of m windows from word ``start`` on that all have an earlier copy."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), "text")
    found = rows.mapInArrow(_occurrence_batches(size, gram), _OCCURRENCE)
    combined = found.mapInArrow(_combined, "anchor long, extent long, doc_id long, rid long, start int, n long")
    # one exchange by anchor serves both the extents and what they say of their anchor
    by_anchor = combined.repartition("anchor")
    extents = by_anchor.groupBy("anchor", "extent").agg(F.min(F.struct(*_PLACE)).alias("first"), F.sum("n").alias("n"))
    anchor = Window.partitionBy("anchor")
    differs = F.min("extent").over(anchor) != F.max("extent").over(anchor)
    known = extents.withColumn("differs", differs).where("n > 1 OR differs")
    known = stored(known.select("anchor", "extent", "first", "differs"), "substring-extents")

    place = F.struct(*_PLACE)
    met = found.join(known, ["anchor", "extent"]).withColumn("later", place != F.col("first"))
    met = stored(met.where("later OR differs").select("anchor", *_PLACE, "m", "later"), "substring-runs")

    firsts = met.where("NOT later").groupBy("doc_id", "rid").agg(F.collect_list(F.struct("anchor", "start", "m")).alias("spans"))
    firsts = firsts.withColumnsRenamed({"doc_id": "__id", "rid": "__of"})
    # rows that repeat id and text are one document
    texts = rows.join(firsts, F.expr("doc_id <=> __id AND rid = __of")).dropDuplicates(["doc_id", "rid"])
    windows = texts.select("doc_id", "rid", "text", "spans").mapInArrow(
        _window_batches(size), "anchor long, window long, doc_id long, rid long, start int"
    )
    windows = stored(windows, "substring-windows")
    copies = windows.join(_first(windows, "anchor", "window"), ["anchor", "window"]).where(place != F.col("first"))
    return met.where("later").select(*_PLACE, "m").union(copies.select(*_PLACE, F.lit(1).alias("m")))


def covered(n_words: int, runs: list[tuple[int, int]], size: int) -> list[list[int]]:
    """[start, end) word spans that the runs of windows cover, joined and in order."""
    spans: list[list[int]] = []
    for start, m in sorted(runs):
        end = start + m + size - 1
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return spans


CUT = "struct<text:string,n_words:long,n_removed:long,spans:array<array<long>>>"


def without_repeats(docs: DataFrame, size: int = MIN_WORDS, gram: int = ANCHOR_WORDS, as_col: str = "cut") -> DataFrame:
    """``docs`` with a struct: the kept words joined by one blank, the counts, the removed [start, end) word spans.

    A null text stays null there.
    """

    def cut_rows(texts: pa.Array, runs: pa.Array) -> pa.Array:
        kept_texts, counts, removed, all_spans = [], [], [], []
        for text, own in zip(binary_list(texts), runs.to_pylist()):
            words = text.split() if text is not None else []
            spans = covered(len(words), [(r["start"], r["m"]) for r in own], size) if own else []
            kept, at = [], 0
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept = kept + words[at:] if spans else words
            kept_texts.append(b" ".join(kept) if text is not None else None)
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            all_spans.append(spans)
        columns = [pa.array(kept_texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
        columns += [pa.array(removed, pa.int64()), pa.array(all_spans, pa.list_(pa.list_(pa.int64())))]
        return pa.StructArray.from_arrays(columns, ["text", "n_words", "n_removed", "spans"])

    @F.arrow_udf(CUT)
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        # Python's words and runs are held for some rows of a batch at a time
        some = [slice(i, i + CUT_ROWS) for i in range(0, max(1, len(texts)), CUT_ROWS)]
        return pa.concat_arrays([cut_rows(texts[s], runs[s]) for s in some])

    found = repeats(docs, size, gram).groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "m")).alias("__runs"))
    found = found.withColumnsRenamed({"doc_id": "__id", "rid": "__of"})
    # the caller's columns travel in one struct, so their names meet none of ours
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long").alias("__doc"), row_key().alias("__rid"))
    joined = keyed.join(found, F.expr("__doc <=> __id AND __rid = __of"), "left")
    return joined.select("__row.*", cut(F.col("__row.text"), F.col("__runs")).alias(as_col))


def report(docs: DataFrame) -> DataFrame:
    """Per document: words, words removed, and the digest of the words that are left."""
    found = without_repeats(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        "cut.n_words",
        "cut.n_removed",
        F.sha2(F.coalesce("cut.text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


#: DuckDB twin of the query: every window is compared as joined text.
ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^ \\t\\n\\x0b\\f\\r]+'), []) AS w FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + %(last)d], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - %(last)d + 1)) AS i FROM docs WHERE len(w) > %(last)d)
),
copies AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + %(last)d + 1)) AS i FROM copies),
placed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
kept AS (
  SELECT p.doc_id, count(g.i) AS n_removed, string_agg(p.word, ' ' ORDER BY p.i) FILTER (WHERE g.i IS NULL) AS t
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
""" % {"last": MIN_WORDS - 1}
