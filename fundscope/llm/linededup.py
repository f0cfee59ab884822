"""Line dedup (8): repeated line runs through a suffix array by prefix doubling.

The corpus is the sequence of line ids of all documents in the order of their
ids.  Round k ranks every run of 2^k lines from the ranks of its two halves:
the distinct pairs that occur at least twice are sorted over the cluster and
numbered in that order, so ranks order suffixes by their first 2^k lines and
equal ranks mean equal runs.  Runs that occur once drop out, which soon leaves
only repeated text.

A repeated run of at least ``MIN_WORDS`` words is covered exactly by minimal
windows: from each line forward, and to each line backward, the fewest lines
that reach ``MIN_WORDS``.  A window of m lines is a prefix of a suffix; the
ranks of its first and last 2^k lines (2^k <= m < 2^(k+1)) name the
longest-common-prefix interval it belongs to.  Of each interval the earliest
window stays and the lines of all others are deleted.  Ranks are needed up to
the longest window only, not up to the longest repeated run.

Every grouping is an aggregate that is combined map-side (count, minimum); the
joins on ranks may have hot keys and are split by AQE's skew join.

Lines are compared without blanks at their ends; words are ``[^ \\t-\\r]+``.
Defined cases: a null text has no lines and stays null; an empty one has one
empty line; blank lines are deleted only inside a repeated run; rows that
repeat id and text are one document; a null id sorts first; ties in the id are
ordered by the text's hash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import binary_list, row_key, stored

MIN_WORDS = 50

_LINE = "doc_id long, rid long, line int, h1 long, h2 long, ahead int, back int"


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the minimal window from each line on, and up to each line (0: none)."""
    n = len(words)
    upto = np.concatenate(([0], np.cumsum(words)))
    last = np.searchsorted(upto, upto[:-1] + least, side="left")  # first end that reaches `least`
    ahead = np.where(last <= n, last - np.arange(n), 0)
    first = np.searchsorted(upto, upto[1:] - least, side="right") - 1  # last start that does
    back = np.where(first >= 0, np.arange(n) + 1 - first, 0)
    return ahead, back


def _line_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "rid", "line", "h1", "h2", "ahead", "back"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        for batch in batches:
            ids, rids, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for doc_id, rid, text in zip(ids, rids, binary_list(batch.column(2))):
                if text is None:
                    continue
                lines = [x.rstrip() for x in text.split(b"\n")]
                ahead, back = windows(np.fromiter((len(x.split()) for x in lines), np.int64, len(lines)), least)
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in lines), np.int64).reshape(-1, 2)
                same = np.full(len(lines), rid, np.int64)
                own = pa.array([doc_id] * len(lines), pa.int64())
                out.append((own, same, np.arange(len(lines)), digests[:, 0], digests[:, 1], ahead, back))
            if out:
                first, *rest = zip(*out)
                columns = [pa.concat_arrays(first), *(pa.array(np.concatenate(c), k) for c, k in zip(rest, kinds[1:]))]
                for at in range(0, len(columns[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([c[at : at + 100_000] for c in columns], names=names)

    return run


def _ranked(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct keys that occur more than once, with a rank in key order (stored: ranks are fixed)."""
    often = pairs.groupBy(*keys).count().where("count > 1").select(*keys)
    return stored(often.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), name)


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rid, start, m): windows of m lines that have an earlier copy."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("rid"), "text")
    lines = stored(rows.mapInArrow(_line_batches(min_words), _LINE), "lines")
    at = ["doc_id", "rid", "line"]
    ranks = _ranked(lines, ["h1", "h2"], "line-ranks")
    # a row that repeats id and text brings the same lines again: once is enough
    active = lines.join(ranks, ["h1", "h2"]).select(*at, "rank", "ahead", "back").dropDuplicates(at)
    active = stored(active, "line-active")
    ahead = active.where("ahead > 0").select("doc_id", "rid", F.col("line").alias("start"), F.col("ahead").alias("m"))
    back = active.where("back > 0").select(
        "doc_id", "rid", (F.col("line") - F.col("back") + 1).alias("start"), F.col("back").alias("m")
    )
    wanted = stored(ahead.union(back).distinct(), "line-windows")
    longest = wanted.agg(F.max("m")).first()[0] or 0

    level = active.select(*at, "rank")
    named = None
    k = 0
    while longest >> k:
        first = level.select("doc_id", "rid", F.col("line").alias("start"), F.col("rank").alias("a"))
        here = wanted.where((F.col("m") >= 1 << k) & (F.col("m") < 2 << k)).join(_same(first), _on("start"))
        here = here.select("doc_id", "rid", "start", "m", "a", (F.col("start") + F.col("m") - (1 << k)).alias("tail"))
        last = level.select("doc_id", "rid", F.col("line").alias("tail"), F.col("rank").alias("b"))
        here = here.join(_same(last), _on("tail")).select("doc_id", "rid", "start", "m", "a", "b")
        named = here if named is None else named.union(here)
        k += 1
        if not longest >> k:
            break
        half = level.select("doc_id", "rid", (F.col("line") - (1 << (k - 1))).alias("line"), F.col("rank").alias("r2"))
        pairs = level.withColumnRenamed("rank", "r1").join(_same(half), _on("line")).select(*at, "r1", "r2")
        ranks = _ranked(pairs, ["r1", "r2"], f"run-ranks-{k}")
        level = stored(pairs.join(ranks, ["r1", "r2"]).select(*at, "rank"), f"runs-{k}")
    if named is None:
        return wanted.limit(0)
    named = stored(named, "line-intervals")
    place = F.struct("doc_id", "rid", "start")
    intervals = named.groupBy("m", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = named.join(intervals, ["m", "a", "b"]).where(place != F.col("first"))
    return copies.select("doc_id", "rid", "start", "m")


def _same(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: f"r_{c}" for c in df.columns if c in ("doc_id", "rid", "start", "tail", "line")})


def _on(place: str):
    """Equal document (a null id equals a null id) and equal line."""
    return F.expr(f"doc_id <=> r_doc_id AND rid = r_rid AND {place} = r_{place}")


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rid, cut): the windows to delete, one row per document that has any."""
    found = repeated_windows(docs, min_words)
    return found.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "m")).alias("cut"))


def kept_lines(lines: list[bytes], cut: list[tuple[int, int]]) -> list[bytes]:
    edge = np.zeros(len(lines) + 1, np.int64)
    for start, m in cut:
        edge[start] += 1
        edge[start + m] -= 1
    return [x for x, gone in zip(lines, np.cumsum(edge[:-1]) > 0) if not gone]


def without_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with their text less the deleted lines, and ``__lines``, ``__deleted`` counts."""

    @F.arrow_udf("struct<text:string,lines:long,deleted:long>")
    def cleaned(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for text, cut in zip(binary_list(texts), cuts.to_pylist()):
            lines = text.split(b"\n") if text is not None else []
            kept = kept_lines(lines, [(c["start"], c["m"]) for c in cut]) if cut else lines
            clean = text if len(kept) == len(lines) else b"\n".join(kept)
            out.append((clean, len(lines), len(lines) - len(kept)))
        columns = list(zip(*out)) if out else [[], [], []]
        text = pa.array(columns[0], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays([text, *(pa.array(c, pa.int64()) for c in columns[1:])], ["text", "lines", "deleted"])

    found = deletions(docs, min_words).withColumnsRenamed({"doc_id": "__id", "rid": "__of", "cut": "__cut"})
    keyed = docs.withColumn("__rid", row_key())
    joined = keyed.join(found, keyed["doc_id"].cast("long").eqNullSafe(found["__id"]) & (keyed["__rid"] == found["__of"]), "left")
    done = joined.withColumn("__done", cleaned("text", "__cut"))
    columns = [F.col("__done.text").alias(c) if c == "text" else F.col(c) for c in docs.columns]
    return done.select(*columns, F.col("__done.lines").alias("__lines"), F.col("__done.deleted").alias("__deleted"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: lines, lines deleted, and the digest of the text that is left."""
    found = without_copies(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__deleted").alias("n_deleted"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


#: DuckDB twin of the query: windows are compared as joined text, without ranks.
ORACLE_SQL = """
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS raw,
         list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '[ \\t\\n\\x0b\\f\\r]+$', '')) AS ls
  FROM documents WHERE text IS NOT NULL
),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM split),
counted AS (
  SELECT doc_id, i, len(regexp_extract_all(line, '[^ \\t\\n\\x0b\\f\\r]+')) AS w FROM lines
),
cum AS (SELECT doc_id, i, w, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM counted),
spans AS (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= %(least)d GROUP BY 1, 2
  UNION
  SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= %(least)d GROUP BY 1, 3
),
texts AS (SELECT p.doc_id, p.s, p.e, array_to_string(d.ls[p.s:p.e], chr(10)) AS t FROM spans p JOIN split d USING (doc_id)),
copies AS (
  SELECT doc_id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY t, e - s ORDER BY doc_id, s) AS nth FROM texts) WHERE nth > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM copies),
left_over AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_deleted,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept
  FROM (SELECT doc_id, unnest(range(1, len(raw) + 1)) AS i, unnest(raw) AS line FROM split) l
  LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY 1
)
SELECT d.doc_id, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_deleted, 0) AS n_deleted, sha256(coalesce(o.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN left_over o USING (doc_id)
""" % {"least": MIN_WORDS}
