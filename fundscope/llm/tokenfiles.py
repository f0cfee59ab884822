"""Token counts (4): a separator scan over flat, unindexed token files.

A token file is nothing but little-endian ids, one document after the other,
each closed by the separator id.  There is no index: the scan reads blocks of
a file in parallel and finds its separators with a vectorised comparison.
Where a block's first document began is settled by a prefix scan over the
blocks (the last separator in any block before), in two levels, so that no
window holds all blocks of a long file.

``write_token_files`` makes such files from documents: ids are stored plus one
and 0 is the separator.  Spark's text writer puts them down, with the two zero
bytes as its line separator, so files are committed like any other output.

Defined cases: an empty file has no documents; two separators in a row close
an empty document (null and empty texts become one); ids after the last
separator are a last document with ``closed`` false; a file whose length is
not a multiple of the id width is an error; repeated rows are written, and
counted, as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundscope.llm.common import shared_path, stored
from fundscope.llm.tokenizer import VOCABULARY, tokenizer

#: Bytes of a block (a multiple of the id width).
BLOCK_BYTES = 4 << 20
#: Blocks of a file whose summaries one window holds.
SUPER_BLOCKS = 4096
SEPARATOR = 0


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY) -> None:
    """One flat file of 16-bit ids (plus one) and separators per partition of ``docs``."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        coder = tokenizer(vocabulary)
        if coder.separator >= (1 << 16) - 1:
            raise ValueError("the vocabulary does not fit 16-bit ids")
        rows = ((np.frombuffer(coder.encode(t), coder.dtype) + 1).astype("<u2").tobytes() for t in texts.to_pylist())
        return pa.array(rows, pa.binary())

    rows = docs.select(encoded("text").cast("string").alias("value"))
    rows.write.option("lineSep", "\0\0").text(path)


def _read(path: str, offset: int, size: int) -> bytes:
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as source:
        return source.read_at(size, offset)


_BLOCK = "path string, block long, tokens long, last long, n long, ends array<long>"


def _scan_batches(separator: int, dtype: str, block_bytes: int):
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{path}: {length} bytes are not whole ids")
                data = _read(path, block * block_bytes, min(block_bytes, length - block * block_bytes))
                ends = np.flatnonzero(np.frombuffer(data, dtype) == separator) + block * (block_bytes // width)
                row = [path, block, length // width, int(ends[-1]) if len(ends) else None, len(ends), ends]
                kinds = [pa.string(), *[pa.int64()] * 4, pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, kinds)], names=["path", "block", "tokens", "last", "n", "ends"]
                )

    return run


def documents_of(
    spark: SparkSession, path: str, separator: int = SEPARATOR, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(path, document, start, n_tokens, closed) of every document in the token files under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    last_block = F.floor((F.col("length") - 1) / F.lit(block_bytes))
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block"))
    blocks = blocks.repartition("path", "block")
    scanned = stored(blocks.mapInArrow(_scan_batches(separator, dtype, block_bytes), _BLOCK), "token-blocks")

    # prefix scan: within super-blocks, and over the super-blocks of a file
    summary = scanned.select("path", "block", "last", "n").withColumn("super", F.floor(F.col("block") / SUPER_BLOCKS))
    inner = Window.partitionBy("path", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("path").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    totals = summary.groupBy("path", "super").agg(F.max("last").alias("last"), F.sum("n").alias("n"))
    totals = totals.select("path", "super", F.max("last").over(outer).alias("far"), F.sum("n").over(outer).alias("many"))
    near = summary.select(
        "path", "block", "super", F.max("last").over(inner).alias("near"), F.sum("n").over(inner).alias("few")
    )
    before = near.join(totals, ["path", "super"]).select(
        "path",
        "block",
        F.coalesce("near", "far", F.lit(-1)).alias("open"),
        (F.coalesce("many", F.lit(0)) + F.coalesce("few", F.lit(0))).alias("done"),
    )
    placed = scanned.join(before, ["path", "block"])
    inside = placed.where("n > 0").select("path", "done", "open", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("ends")[F.col("k") - 1]) + 1
    closed = inside.select("path", (F.col("done") + F.col("k")).alias("document"), start.alias("start"), "end")
    closed = closed.select("path", "document", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = scanned.groupBy("path").agg(F.max("last").alias("last"), F.max("tokens").alias("tokens"), F.sum("n").alias("n"))
    start = F.coalesce("last", F.lit(-1)) + 1
    rest = ends.where(start < F.col("tokens")).select(
        "path", F.col("n").alias("document"), (F.col("tokens") - start).alias("n_tokens"), start.alias("start"), F.lit(False).alias("closed")
    )
    return closed.unionByName(rest).select("path", "document", "start", "n_tokens", "closed")


def report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Writes the token files of ``docs`` and counts the tokens of every document in them."""
    spark = docs.sparkSession
    path = shared_path(spark, "token-files")
    write_token_files(docs, path, vocabulary)
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("part")
    return documents_of(spark, path).select(part, "document", "start", "n_tokens")
