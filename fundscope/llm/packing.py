"""Token-ID / binary output (9): best-fit-decreasing packing into fixed rows.

Every document becomes its token ids and one separator.  A document longer
than a row is split without loss into full rows and a rest.  The pieces of a
partition are packed in windows of ``WINDOW_TOKENS`` tokens: longest first,
each into the fullest row that still has room, found in a segment tree over
row capacities.  What a task holds is one window, and no shuffle is needed.

A packed row holds the ids (little-endian binary, ``row_tokens`` of them, the
rest filled with the separator), the cumulative segment lengths, the places
where positions reset to 0, the resets' position offsets (a split document's
piece continues where the last one ended), and doc_id and piece of every
segment.

Defined cases: a null or empty text is one separator; repeated rows are packed
as often as they occur; a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.tokenizer import VOCABULARY, tokenizer

ROW_TOKENS = 4096
#: Tokens that are packed together.
WINDOW_TOKENS = 2_000_000

SCHEMA = (
    "doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, position_resets array<int>, "
    "position_offsets array<long>, n_tokens int, input_ids binary"
)
_ARROW = pa.schema([
    ("doc_ids", pa.list_(pa.int64())),
    ("pieces", pa.list_(pa.int32())),
    ("cu_seqlens", pa.list_(pa.int32())),
    ("position_resets", pa.list_(pa.int32())),
    ("position_offsets", pa.list_(pa.int64())),
    ("n_tokens", pa.int32()),
    ("input_ids", pa.binary()),
])


class Capacities:
    """Open rows by free capacity: a segment tree that counts rows, for best-fit search."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def _add(self, free: int, by: int) -> None:
        node = self.leaves + free
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, free: int, row: int) -> None:
        self.rows.setdefault(free, []).append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of the fullest row with at least ``need`` free, taken out."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1  # up until a right sibling has rows
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        free = node - self.leaves
        self._add(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers; every piece is at most ``capacity`` long."""
    rows: list[list[int]] = []
    open_rows = Capacities(capacity)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_rows.take(lengths[piece])
        free, row = found if found else (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if free > lengths[piece]:
            open_rows.put(free - lengths[piece], row)
    return rows


def _pack_batches(row_tokens: int, window_tokens: int, vocabulary: str):
    def packed(pieces: list[tuple], coder) -> Iterator[pa.RecordBatch]:
        width = coder.dtype.itemsize
        filler = np.array([coder.separator], coder.dtype).tobytes()
        rows = []
        for row in best_fit_decreasing([len(p[3]) // width for p in pieces], row_tokens):
            segments = [pieces[i] for i in row]
            ends = np.cumsum([len(s[3]) // width for s in segments]).tolist()
            ids = b"".join(s[3] for s in segments)
            rows.append((
                [s[0] for s in segments], [s[1] for s in segments], [0, *ends], [0, *ends[:-1]],
                [s[2] for s in segments], ends[-1], ids + filler * (row_tokens - ends[-1]),
            ))
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 256]), _ARROW)], schema=_ARROW
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        step = row_tokens * coder.dtype.itemsize
        end = np.array([coder.separator], coder.dtype).tobytes()
        pieces, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = coder.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    pieces.append((doc_id, k, k * row_tokens, ids[at : at + step]))
                    held += min(step, len(ids) - at)
                    if held >= window_tokens * coder.dtype.itemsize:
                        yield from packed(pieces, coder)
                        pieces, held = [], 0
        if pieces:
            yield from packed(pieces, coder)

    return run


def pack(
    docs: DataFrame, row_tokens: int = ROW_TOKENS, window_tokens: int = WINDOW_TOKENS, vocabulary: str = VOCABULARY
) -> DataFrame:
    """The packed rows of all documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_pack_batches(row_tokens, window_tokens, vocabulary), SCHEMA)


def unpack(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, piece, ids) of every segment, as it went in; for tests and readers."""
    width = tokenizer(vocabulary).dtype.itemsize
    segments = rows.select(F.posexplode("doc_ids").alias("k", "doc_id"), "pieces", "cu_seqlens", "input_ids")
    start, end = F.col("cu_seqlens")[F.col("k")], F.col("cu_seqlens")[F.col("k") + 1]
    ids = F.substring("input_ids", start * width + 1, (end - start) * width)
    return segments.select("doc_id", F.col("pieces")[F.col("k")].alias("piece"), ids.alias("ids"))


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows as Parquet files."""
    pack(docs, **options).write.parquet(path)
