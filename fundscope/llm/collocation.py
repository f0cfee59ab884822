r"""Phrase collocation mining (12): counts from depth-truncated suffix subtrees, group by group.

A-Z are lower-cased, texts are split at ``[.,;:!?\n-\r]`` into pieces and those
into words ``[^ \t]+``.  Everything is counted per lang (null: ``und``): n all
word occurrences, f(phrase) all contiguous occurrences within pieces.
Candidates are phrases of 2 to ``WORDS`` words with a = f >= ``LEAST``.  Cut
after k words, a candidate scores floor(1000 a n / (f(first part) f(rest)));
its lowest cut counts (ties: smallest k).  A candidate inside a longer one of
the same frequency is dropped; each lang's best ``TOP`` are ranked by score
descending, a descending, phrase ascending (UTF-8 byte order).

Pruning.  One pass hashes words and word pairs to 2^``SLOT_BITS`` slots and
sums them up; the slots that reach ``LEAST`` form a bitmap of fixed size (32
MB), which is broadcast.  A second pass does the same for the longer phrases
that consist of such pairs, and marks the words of such pairs.  A phrase can
only reach ``LEAST`` if all its parts do, so a slot below rules it out; slots
that several phrases share only let more through.

Suffixes.  A third pass truncates the suffix at each marked word to its longest
phrase that no slot rules out (at most ``WORDS`` words), and counts equal ones
(the leaves) within a task.  A task sends its leaves as one row per bucket of
their first word; the leaves of a bucket meet in one task and are added up.

Vertical partitioning.  Leaves are grouped by their word prefix: a prefix with
more than ``GROUP_LEAVES`` leaves is lengthened by a word, as often as needed;
prefixes are hashed to ``BUCKETS`` buckets, and buckets are packed into groups
within the budget (first fit of the decreasing sizes).  Each group builds its
subtree alone (sorted leaves; a node is a run that agrees on its first words)
and reads each node's count from its leaf totals.  Nodes above a lengthened
prefix are sums over several groups.

Words are told apart by 64-bit hashes (exact for words of up to eight bytes of
one length; a clash among the words of frequent pairs is an error).  Products
are decimals of 38 digits.

Defined cases: null and empty texts have no words; rows that repeat count each;
a lang without candidates has no rows; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.bytewords import Words, byte_table, mixed, portions
from fundscope.llm.common import LOWER, UPPER, stored

WORDS = 5
LEAST = 100
TOP = 2000
#: The bitmap holds 2^28 bits (32 MB); raise it beyond some 10^10 words.
SLOT_BITS = 28
#: Slots that are summed up together.
RANGE_BITS = 20
#: Word occurrences whose slots a task sums up before it sends them.
SLOT_WORDS = 4_000_000
#: Leaves that a task combines before it sends them.
COMBINE_ROWS = 1_000_000
#: Leaves in a group (some 60 bytes each).
GROUP_LEAVES = 500_000
BUCKETS = 65_536

_PIECES = b".,;:!?\n\x0b\x0c\r"
_TABLE = byte_table(b" \t" + _PIECES, lower=True)
_IS_PIECE = np.isin(np.arange(256), list(_PIECES))
_PATH = [f"w{i}" for i in range(1, WORDS + 1)]
#: Buckets of first words: a task sends one row per bucket, with all its leaves there.
LEAF_BUCKETS = 4096
_LEAVES = ["langs", "depths", *_PATH, "counts"]
_FOUND = (
    "kind string, bucket int, langs array<string>, depths array<int>, "
    + ", ".join(f"{w} array<long>" for w in _PATH)
    + ", counts array<long>, names array<string>, hashes array<long>, name string, n long"
)


def paired(words: Words) -> np.ndarray:
    """Whether each word and the next stand in one piece of one text."""
    if not len(words.starts):
        return np.zeros(0, bool)
    piece = np.cumsum(_IS_PIECE[words.data], dtype=np.int64)[words.starts]
    text = words.text_of_word()
    return np.append((piece[1:] == piece[:-1]) & (text[1:] == text[:-1]), False)


class Langs:
    """Numbers the langs of a column and gives each a hash."""

    def __init__(self, column: pa.Array):
        coded = column.cast(pa.string()).fill_null("und").dictionary_encode()
        self.code = coded.indices.to_numpy()
        self.names = coded.dictionary
        seeds = [xxhash.xxh3_64_intdigest((x or "").encode()) for x in coded.dictionary.to_pylist()]
        self.seed = np.array(seeds, np.uint64)

    def of(self, words: Words) -> np.ndarray:
        """The lang number of each word."""
        return np.repeat(self.code[words.first : words.first + words.texts], np.diff(words.bounds))


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MARK = np.uint64(0xD1342543DE82EF95)


def first_grams(hashes: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word in its lang, and of each word with the next (the last has none)."""
    word = mixed(hashes ^ seed)
    return word, mixed(word[:-1] * _GOLD + hashes[1:])


def longer_grams(hashes: np.ndarray, pair: np.ndarray, ok: np.ndarray, most: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, hashes) of the phrases of 3 to ``most`` words whose pairs are all ``ok``.

    The receiver may send back which of them to lengthen."""
    at = np.flatnonzero(ok)
    gram = pair[at]
    for d in range(3, most + 1):
        on = at + d - 2
        kept = on < len(ok)
        kept[kept] = ok[on[kept]]
        at = at[kept]
        gram = mixed(gram[kept] * _GOLD + hashes[at + d - 1])
        wanted = yield d, at, gram
        if wanted is not None:
            at, gram = at[wanted], gram[wanted]


class Bitmap:
    """The slots that reach the threshold."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = np.uint64(64 - (len(bits) * 8).bit_length() + 1)

    def has(self, grams: np.ndarray) -> np.ndarray:
        slot = grams >> self.shift
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def pairs(self, word: np.ndarray, pair: np.ndarray, linked: np.ndarray) -> np.ndarray:
        """Whether each word makes a frequent pair with the next."""
        ok = np.zeros(len(word), bool)
        some = np.flatnonzero(linked)
        some = some[self.has(pair[some])]
        ok[some] = self.has(word[some]) & self.has(word[some + 1])
        return ok


def _slot_batches(least: int, slot_bits: int, held=None, slot_words: int = SLOT_WORDS):
    """Slot counts by range: of words and pairs, or with the bitmap of those of longer phrases and marked words."""
    kind = np.uint8 if least < 256 else np.uint32
    low = (1 << RANGE_BITS) - 1
    shift = np.uint64(64 - slot_bits)

    def sent(found: list[np.ndarray], marked: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        slot, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint32)]), return_counts=True)
        if marked:
            # a marked word counts as frequent
            marks = np.unique(np.concatenate(marked))
            slot, place = np.unique(np.concatenate((slot, marks)), return_inverse=True)
            full = np.zeros(len(slot), np.int64)
            full[place[: len(n)]] = n
            full[place[len(n) :]] = least
            n = full
        if not len(slot):
            return
        n = np.minimum(n, least).astype(kind)  # beyond that a slot is frequent anyhow
        part = slot >> RANGE_BITS
        cuts = np.flatnonzero(np.diff(part)) + 1
        rows = [(int(p[0]), (s & low).astype(np.uint32).tobytes(), c.tobytes())
                for p, s, c in zip(np.split(part, cuts), np.split(slot, cuts), np.split(n, cuts))]
        parts, *binary = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *map(pa.array, binary)], names=["part", "slots", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Bitmap(held.value) if held else None
        found, marked, n = [], [], 0
        for batch in batches:
            langs = Langs(batch.column(0))
            for words in portions(batch.column(1), _TABLE):
                if not len(words.starts):
                    continue
                hashes = words.hashes()
                word, pair = first_grams(hashes, langs.seed[langs.of(words)])
                linked = paired(words)
                if frequent is None:
                    found += [(word >> shift).astype(np.uint32), (pair[linked[:-1]] >> shift).astype(np.uint32)]
                else:
                    ok = frequent.pairs(word, pair, linked)
                    found += [(gram >> shift).astype(np.uint32) for _, _, gram in longer_grams(hashes, pair, ok)]
                    ok[1:] |= ok[:-1]
                    marked.append(np.unique((word[ok] ^ _MARK) >> shift).astype(np.uint32))
                n += len(word)
                if n >= slot_words:
                    yield from sent(found, marked)
                    found, marked, n = [], [], 0
        if n:
            yield from sent(found, marked)

    return run


def _frequent_batches(least: int):
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, slot, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = sums.setdefault(part, np.zeros(1 << RANGE_BITS, np.uint16 if least < 1 << 15 else np.int64))
                at = np.frombuffer(slot, np.uint32)
                own[at] = np.minimum(own[at] + np.frombuffer(n, kind), least)
        for part, own in sums.items():
            there = own >= least
            if there.any():
                bits = np.packbits(there, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits])], names=["part", "bits"])

    return run


def frequent_slots(rows: DataFrame, least: int, slot_bits: int = SLOT_BITS, held=None) -> np.ndarray:
    """The bitmap of slots that reach ``least``: 2^slot_bits bits, however large the input."""
    ranges = 1 << (slot_bits - RANGE_BITS)
    sent = rows.mapInArrow(_slot_batches(least, slot_bits, held), "part int, slots binary, counts binary")
    bits = np.zeros(1 << (slot_bits - 3), np.uint8)
    size = 1 << (RANGE_BITS - 3)
    frequent = sent.repartition(ranges, "part").mapInArrow(_frequent_batches(least), "part int, bits binary")
    for r in frequent.collect():  # the bitmap, no more
        bits[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return bits


def suffixes(
    hashes: np.ndarray, start: np.ndarray, pair: np.ndarray, ok: np.ndarray, longer, most: int = WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, depths, paths) of the truncated suffixes at the ``start`` words; paths end in zeros.

    ``ok``: words that make a frequent pair with the next; ``longer``: tells which hashes of longer phrases are frequent.
    """
    deep = 1 + ok.astype(np.int64)
    grams = longer_grams(hashes, pair, ok, most)
    step = next(grams, None)
    while step:
        d, at, gram = step
        wanted = longer(gram)
        deep[at[wanted]] = d
        try:
            step = grams.send(wanted)
        except StopIteration:
            break
    at = np.flatnonzero(start)
    depth = deep[at]
    path = np.zeros((len(at), most), np.uint64)
    for d in range(most):
        there = np.flatnonzero(depth > d)
        path[there, d] = hashes[at[there] + d]
    return at, depth, path


def _combined(table: pa.Table) -> pa.Table:
    keys = [c for c in table.column_names if c != "n"]
    out = table.group_by(keys, use_threads=False).aggregate([("n", "sum")])
    return out.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


_SCHEMA = pa.schema([
    ("kind", pa.string()), ("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("depths", pa.list_(pa.int32())),
    *((w, pa.list_(pa.int64())) for w in _PATH), ("counts", pa.list_(pa.int64())),
    ("names", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())), ("name", pa.string()), ("n", pa.int64()),
])


def _rows(kind: str, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Rows of one kind; columns that are not given are null."""
    rows = len(next(iter(columns.values())))
    given = {"kind": pa.array([kind] * rows, pa.string())} | columns
    return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(rows, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _by_bucket(kind: str, bucket: np.ndarray, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """One row per bucket, with lists of its values."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    head = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(head, len(bucket)), pa.int32())
    lists = {c: pa.ListArray.from_arrays(offsets, x.take(pa.array(order))) for c, x in columns.items()}
    whole = _rows(kind, {"bucket": pa.array(bucket[head])} | lists)
    for i in range(0, len(head), 512):
        yield whole.slice(i, 512)


def packed_leaves(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The leaves (lang, depth, w1 to w5, n) by the bucket of their first word."""
    lang = table["lang"].combine_chunks().dictionary_encode()
    seeds = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in lang.dictionary.to_pylist()], np.uint64)
    first = table["w1"].to_numpy().view(np.uint64)
    bucket = (mixed(first ^ seeds[lang.indices.to_numpy()]) % np.uint64(LEAF_BUCKETS)).astype(np.int64)
    columns = {to: table[c].combine_chunks() for to, c in zip(_LEAVES, ["lang", "depth", *_PATH, "n"])}
    yield from _by_bucket("leaf", bucket, columns)


def _merged_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct leaves of whole buckets, with their counts added up."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        flat = {c: batch.column(to).flatten() for to, c in zip(_LEAVES, ["lang", "depth", *_PATH, "n"])}
        held.append(pa.table(flat))
        size += len(held[-1])
        if size > 2 * len(held[0]) + COMBINE_ROWS:
            held = [_combined(pa.concat_tables(held))]
            size = len(held[0])
    if held:
        yield from _combined(pa.concat_tables(held)).to_batches(max_chunksize=50_000)


def _leaf_batches(held_bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, longer = (Bitmap(x) for x in held_bits.value)
        totals: dict[str, int] = {}
        known: dict[int, bytes] = {}
        told: set[int] = set()
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            langs = Langs(batch.column(0))
            for words in portions(batch.column(1), _TABLE):
                if not len(words.starts):
                    continue
                hashes, lang = words.hashes(), langs.of(words)
                for code, n in enumerate(np.bincount(lang, minlength=len(langs.names)).tolist()):
                    name = langs.names[code].as_py()
                    totals[name] = totals.get(name, 0) + n
                word, pair = first_grams(hashes, langs.seed[lang])
                ok = frequent.pairs(word, pair, paired(words))
                used = ok.copy()
                used[1:] |= ok[:-1]
                at, depth, path = suffixes(hashes, longer.has(word ^ _MARK), pair, ok, longer.has)
                for single in (True, False):
                    mine = (depth == 1) == single
                    if not mine.any():
                        continue
                    keys = {"lang": pa.array(lang[at[mine]], pa.int32())}
                    if single:
                        keys["w1"] = pa.array(path[mine, 0].view(np.int64))
                    else:
                        keys["depth"] = pa.array(depth[mine], pa.int32())
                        keys |= {w: pa.array(path[mine, i].view(np.int64)) for i, w in enumerate(_PATH)}
                    keys["n"] = pa.array(np.ones(int(mine.sum()), np.int64))
                    table = _combined(pa.table(keys))
                    full = len(table)
                    zeros, one = pa.array(np.zeros(full, np.int64)), pa.array(np.ones(full, np.int32))
                    columns = {"lang": langs.names.take(table["lang"].combine_chunks()), "depth": table["depth"] if not single else one}
                    columns |= {w: table[w] if w in table.column_names else zeros for w in _PATH}
                    held.append(pa.table(columns | {"n": table["n"]}))
                    size += full
                # the words of frequent pairs, once a task
                there = np.flatnonzero(used)
                unique, place = np.unique(hashes[there], return_index=True)
                for h, i in zip(unique.tolist(), there[place].tolist()):
                    if h not in told:
                        known[h] = words.word(i)
                        told.add(h)
                if size >= COMBINE_ROWS:
                    whole = _combined(pa.concat_tables(held))
                    held, size = ([whole], len(whole)) if len(whole) < COMBINE_ROWS // 2 else ([], 0)
                    if not held:
                        yield from packed_leaves(whole)
                if len(known) >= 50_000:
                    yield from _word_rows(known)
                    known = {}
        if held:
            yield from packed_leaves(_combined(pa.concat_tables(held)))
        yield from _word_rows(known)
        yield _rows("total", {"name": pa.array(list(totals), pa.string()), "n": pa.array(list(totals.values()), pa.int64())})

    return run


def _word_rows(known: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    """Words and their hashes by bucket of the hash."""
    h = np.fromiter(known, np.uint64, len(known))
    names = pa.array(list(known.values()), pa.binary()).cast(pa.string())
    yield from _by_bucket("word", (mixed(h) % np.uint64(LEAF_BUCKETS)).astype(np.int64), {"names": names, "hashes": pa.array(h.view(np.int64))})


def _merged_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of whole buckets."""
    known: dict[int, str] = {}
    for batch in batches:
        for h, word in zip(batch.column("hashes").flatten().to_pylist(), batch.column("names").flatten().to_pylist()):
            if known.setdefault(h, word) != word:
                raise ValueError(f"two words share a hash: {known[h]!r}, {word!r}")
    yield pa.RecordBatch.from_arrays([pa.array(list(known), pa.int64()), pa.array(list(known.values()), pa.string())], names=["h", "word"])


def packed(sizes: dict[int, int], budget: int) -> dict[int, int]:
    """The group of each bucket: first fit of the decreasing sizes into groups of at most ``budget``."""
    groups: list[tuple[int, int]] = []  # (filled, group)
    out: dict[int, int] = {}
    for bucket, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if groups and groups[0][0] + n <= budget:
            filled, group = heapq.heappop(groups)
        else:
            filled, group = 0, len(groups)
        heapq.heappush(groups, (filled + n, group))
        out[bucket] = group
    return out


def grouped_leaves(leaves: DataFrame, budget: int) -> DataFrame:
    """``leaves`` with the length of their prefix (``cut``) and their group."""
    rows = leaves.withColumn("cut", F.lit(1))
    for d in range(1, WORDS):
        keys = ["lang", *_PATH[:d]]
        heavy = rows.where(F.col("cut") == d).groupBy(*keys).count().where(F.col("count") > budget)
        heavy = stored(heavy.select(*keys, F.lit(True).alias("heavy")), f"collocation-heavy-{d}")
        if heavy.isEmpty():
            break
        rows = rows.join(heavy, keys, "left").withColumn("cut", F.when(F.col("heavy"), d + 1).otherwise(F.col("cut"))).drop("heavy")
    prefix = [F.when(F.col("cut") > i, F.col(w)) for i, w in enumerate(_PATH)]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("lang", "cut", *prefix), F.lit(BUCKETS)).cast("int"))
    sizes = {r["bucket"]: r["count"] for r in rows.groupBy("bucket").count().collect()}  # at most BUCKETS rows
    groups = leaves.sparkSession.createDataFrame(list(packed(sizes, budget).items()), "bucket int, group int")
    return rows.join(F.broadcast(groups), "bucket")


def subtree(table: pa.Table) -> pa.Table:
    """(lang, path, f) of the nodes of one group, counts read from its leaves."""
    names = ["lang", *_PATH]
    order = pc.sort_indices(table, [(c, "ascending") for c in names])
    table = table.take(order)
    lang = table["lang"].combine_chunks().dictionary_encode()
    columns = [lang.indices.to_numpy(), *(table[w].to_numpy() for w in _PATH)]
    depth, n = table["depth"].to_numpy(), table["n"].to_numpy()
    langs, paths, counts = [], [], []
    new = np.zeros(len(depth), bool)
    new[:1] = True
    new[1:] = columns[0][1:] != columns[0][:-1]
    for d in range(1, WORDS + 1):
        new[1:] |= columns[d][1:] != columns[d][:-1]
        deep = depth >= d
        # a run of equal first words starts at its first leaf that is deep enough
        node = np.cumsum(new)[deep]
        rows = np.flatnonzero(deep)
        if not len(rows):
            break
        head = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        counts.append(np.add.reduceat(n[rows], head))
        at = rows[head]
        langs.append(lang.take(pa.array(at)).cast(pa.string()))
        path = np.stack([columns[i][at] for i in range(1, d + 1)], axis=1)
        paths.append(pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * d, pa.int32()), pa.array(path.ravel())))
    return pa.table({"lang": pa.concat_arrays(langs), "path": pa.concat_arrays(paths), "f": pa.array(np.concatenate(counts))})


def phrases(found: DataFrame, least: int, budget: int = GROUP_LEAVES) -> DataFrame:
    """(lang, path, f): words and phrases with f >= least."""
    leaves = found.where("kind = 'leaf'").select("bucket", *_LEAVES).repartition("bucket").select(*_LEAVES)
    kinds = "lang string, depth int, " + ", ".join(f"{w} long" for w in _PATH) + ", n long"
    leaves = leaves.mapInArrow(_merged_batches, kinds)
    grouped = grouped_leaves(stored(leaves, "collocation-leaves"), budget)
    nodes = grouped.groupBy("group").applyInArrow(subtree, "lang string, path array<long>, f long")
    # nodes above a lengthened prefix come from several groups
    return nodes.groupBy("lang", "path").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, budget: int = GROUP_LEAVES, slot_bits: int = SLOT_BITS
) -> DataFrame:
    """Each lang's best phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    pairs = frequent_slots(rows, least, slot_bits)
    longer = frequent_slots(rows, least, slot_bits, spark.sparkContext.broadcast(pairs))
    bits = spark.sparkContext.broadcast((pairs, longer))
    found = stored(rows.mapInArrow(_leaf_batches(bits), _FOUND), "collocation-found")
    common = stored(phrases(found, least, budget), "collocation-phrases")
    words = found.where("kind = 'word'").select("bucket", "names", "hashes").repartition("bucket")
    words = words.mapInArrow(_merged_words, "h long, word string")
    totals = found.where("kind = 'total'").groupBy(F.col("name").alias("lang")).agg(F.sum("n").alias("n"))

    size = F.size("path")
    asked = common.where(size > 1).withColumnRenamed("f", "a")
    inner = asked.where(size > 2).select(
        "lang", F.explode(F.array(F.slice("path", 1, size - 1), F.slice("path", 2, size - 1))).alias("path"), "a"
    )
    kept = asked.join(inner.distinct(), ["lang", "path", "a"], "left_anti")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("*", F.slice("path", F.lit(1), F.col("k")).alias("head"), F.slice("path", F.col("k") + 1, size - F.col("k")).alias("rest"))
    heads = common.select("lang", F.col("path").alias("head"), F.col("f").alias("l"))
    rests = common.select("lang", F.col("path").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    big = lambda c: f"CAST({c} AS DECIMAL(38, 0))"
    score = F.expr(f"({big('1000')} * {big('a')} * {big('n')}) DIV ({big('l')} * {big('r')})").cast("long")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "path", "a", "n").agg(low).select("lang", "path", "a", "low.l", "low.r", "n", "low.score")
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored = stored(scored.withColumn("place", F.rank().over(near)).where(F.col("place") <= top), "collocation-scores")

    spelled = scored.select("lang", "path", F.posexplode("path").alias("at", "h")).join(words, "h")
    spelled = spelled.groupBy("lang", "path").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.join(spelled, ["lang", "path"]).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB twin of the query: all phrases are counted as joined text.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '%(upper)s', '%(lower)s'), '[.,;:!?\n\x0b\f\r]')) AS p
  FROM documents
),
ws AS (SELECT lang, regexp_extract_all(p, '[^ \t]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM ws GROUP BY 1),
often AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, range(1, %(words)d + 1) AS t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= %(least)d
),
kept AS (
  SELECT * FROM often c WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM often x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.f >= 100 * c.f
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(w[:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM kept)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, r.f AS r, t.n, c.j,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(h.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN often h ON c.lang = h.lang AND c.head = h.phrase JOIN often r ON c.lang = r.lang AND c.rest = r.phrase
  JOIN total t ON c.lang = t.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest
)
SELECT * FROM ranked WHERE rank <= %(top)d
""" % {"upper": UPPER, "lower": LOWER, "words": WORDS, "least": LEAST, "top": TOP}
