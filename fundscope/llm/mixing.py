"""Mixing sources to target weights (10): temperature mixing.

Each source's share of all tokens is raised to an exponent and normalised.
The exponent (1: as found, 0: uniform) is bisected to the smallest temperature
change that reaches a target: an entropy (a share of the uniform mix's), or
the most often that any source may be repeated.  Of the two, the stricter
counts: a mix never repeats a source more often than the limit allows.

The weights are realised as epochs of each source.  A source's documents are
dealt by hash to blocks; each epoch reads the blocks in its own permuted
order.  Whole epochs take every block; the last, partial one takes blocks from
the front of its permutation until the source's budget is used, so a source
gets its budget up to one block.  Budget None is the smallest one that uses
every source in full at least once, so nothing is left out.

Sizes: per source, per document and per block sums are combined map-side; the
driver gets one row per source (``MAX_SOURCES`` at most, else an error) and per
source and step of the permutation.  No window or group
holds a source's documents, however hot the source is.  ``mix`` shuffles its
rows once, into ranges of the mix's order.

Defined cases: a null source is a source of its own; null and empty texts have
no tokens and go with their block; a source without tokens gets one epoch; an
empty table gives an empty result; repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import stored

#: Share of the uniform mix's entropy to reach.
TARGET_ENTROPY = 0.93
#: Epochs of a source at most.
MAX_REPEATS = 4.0
#: Tokens of a block on average.
BLOCK_TOKENS = 20_000
#: Blocks of a source at most (beyond that, blocks grow).
MAX_BLOCKS = 1 << 16
#: A permutation's places are numbers below 2^62; the partial epoch is cut at one of 256 steps, then at a block.
STEP = 1 << 54
MAX_SOURCES = 10_000
SEED = 7


@dataclass(frozen=True)
class Mix:
    exponent: float
    entropy: float
    weights: dict[str | None, float]
    epochs: dict[str | None, float]


def tokens_of(text_col: str = "text") -> Column:
    """Words of a text, split at blanks: the token count that budgets are in."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised ``share ** exponent`` of the sources with tokens; others weigh 0."""
    total = sum(tokens)
    raw = [(n / total) ** exponent if n else 0.0 for n in tokens]
    return [x / sum(raw) for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def epochs_at(tokens: list[int], weights: list[float], budget: float | None) -> list[float]:
    """Times that each source is read; without a budget the least-read source is read once."""
    rates = [w / n if n else math.inf for w, n in zip(weights, tokens)]
    budget = 1 / min(rates) if budget is None else budget
    return [budget * r if n else 1.0 for r, n in zip(rates, tokens)]


def solve(
    tokens: dict[str | None, int],
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: float | None = None,
) -> Mix:
    """The largest exponent whose mix reaches the entropy, raised where repeats would exceed the limit."""
    names = sorted(tokens, key=lambda s: (s is not None, s or ""))
    counts = [tokens[s] for s in names]
    if not any(counts):
        return Mix(1.0, 0.0, dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0))
    goal = target_entropy * math.log(max(1, sum(n > 0 for n in counts)))

    def bisect(low_ok, exponent_low: float, exponent_high: float) -> float:
        """The largest exponent at which ``low_ok`` holds; it holds below one point and fails above."""
        if low_ok(exponent_high):
            return exponent_high
        for _ in range(60):
            mid = (exponent_low + exponent_high) / 2
            exponent_low, exponent_high = (mid, exponent_high) if low_ok(mid) else (exponent_low, mid)
        return exponent_low

    flat_enough = bisect(lambda e: entropy(weights_at(counts, e)) >= goal, 0.0, 1.0)
    # repeats fall as the exponent rises to 1, so the limit is a lower bound of the exponent
    repeats = lambda e: max(epochs_at(counts, weights_at(counts, e), budget))
    too_often = bisect(lambda e: repeats(e) > max_repeats, 0.0, 1.0) if repeats(0.0) > max_repeats else 0.0
    exponent = max(flat_enough, too_often)
    weights = weights_at(counts, exponent)
    epochs = [min(x, max_repeats) for x in epochs_at(counts, weights, budget)]
    return Mix(exponent, entropy(weights), dict(zip(names, weights)), dict(zip(names, epochs)))


def _permuted(*key) -> Column:
    """A number in [0, 2^62) that permutes blocks: hash order of the key."""
    return F.pmod(F.xxhash64(F.lit(SEED), *key), F.lit(1 << 62))


def _key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.lit(SEED), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def source_tokens(rows: DataFrame) -> dict[str | None, int]:
    """Tokens of every source, from rows (source, n_tokens)."""
    found = rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them first")
    return {r["source"]: int(r["n"]) for r in found}


class Schedule:
    """Which blocks of which source are read how often."""

    def __init__(self, rows: DataFrame, target_entropy: float, max_repeats: float, budget: float | None):
        """``rows``: (source, key, n_tokens), one per document, stored."""
        self.spark = rows.sparkSession
        tokens = source_tokens(rows)
        self.mix = solve(tokens, target_entropy, max_repeats, budget)
        self.sources = []
        for s, n in tokens.items():
            full = int(self.mix.epochs[s] + 1e-9)
            part = max(0.0, self.mix.epochs[s] - full) if n else 0.0
            blocks = min(MAX_BLOCKS, max(1, round(n / BLOCK_TOKENS)))
            self.sources.append((s, blocks, full, part if part > 1e-9 else 0.0, n))
        self.upto = self._limits(rows)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Adds (__blocks, __full, __part, __block, __last) by source and key."""
        schema = "__s string, __blocks long, __full long, __part double, __n long"
        known = self.spark.createDataFrame(self.sources, schema).coalesce(1)  # MAX_SOURCES rows at most
        placed = rows.join(F.broadcast(known), F.col("__source").eqNullSafe(F.col("__s")))
        placed = placed.withColumn("__block", F.pmod(F.col("__key"), F.col("__blocks")))
        return placed.withColumn("__last", _permuted("__source", F.col("__full"), "__block"))

    def _limits(self, rows: DataFrame) -> list[tuple[str | None, int]]:
        """For each source with a partial epoch, where its permutation ends: at a step, then at a block."""
        rows = rows.select(F.col("source").alias("__source"), F.col("key").alias("__key"), "n_tokens")
        partial = self._placed(rows).where("__part > 0")
        step = F.floor(F.col("__last") / F.lit(STEP)).cast("long")
        sums: dict[str | None, list] = {}
        for r in partial.groupBy("__source", step.alias("step")).agg(F.sum("n_tokens").alias("n")).collect():
            sums.setdefault(r["__source"], []).append((r["step"], r["n"]))
        cuts = {}
        for s, _, _, part, n in self.sources:
            left, at = part * n, 0
            for at, own in sorted(sums.get(s, [])):
                if own > left:
                    break
                left -= own
            cuts[s] = (at, left)
        if not sums:
            return []
        known = self.spark.createDataFrame([(s, at) for s, (at, _) in cuts.items()], "__c string, __cut long").coalesce(1)
        inside = partial.join(F.broadcast(known), F.col("__source").eqNullSafe(F.col("__c"))).where(step == F.col("__cut"))
        blocks: dict[str | None, list] = {}
        for r in inside.groupBy("__source", "__last").agg(F.sum("n_tokens").alias("n")).collect():
            blocks.setdefault(r["__source"], []).append((r["__last"], r["n"]))
        limits = []
        for s in sums:
            at, left = cuts[s]
            end = at * STEP
            for place, own in sorted(blocks.get(s, [])):
                if left <= 0:
                    break
                end, left = place + 1, left - own  # a block that crosses the budget is read whole
            limits.append((s, end))
        return limits

    def repeated(self, rows: DataFrame) -> DataFrame:
        """``rows`` with (__source, __key), repeated to the mix; adds (__epoch, __block, __place, __progress).

        __progress: how much of all its source's epochs lies before the block, 0 to 1.
        """
        known = self.spark.createDataFrame(self.upto, "__l string, __upto long").coalesce(1)
        placed = self._placed(rows).join(F.broadcast(known), F.col("__source").eqNullSafe(F.col("__l")), "left")
        partial = (F.col("__part") > 0) & (F.col("__last") < F.col("__upto"))
        times = F.col("__full") + F.when(partial, 1).otherwise(0)
        epochs = placed.withColumn("__times", times).where("__times > 0")
        epochs = epochs.withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__times") - 1)))
        epochs = epochs.withColumn("__place", _permuted("__source", "__epoch", "__block"))
        whole = F.lit(float(1 << 62))
        # the partial epoch ends at its limit
        length = F.col("__full") + F.when(F.col("__part") > 0, F.coalesce("__upto", F.lit(0)) / whole).otherwise(0.0)
        return epochs.withColumn("__progress", (F.col("__epoch") + F.col("__place") / whole) / length)


def _rows(docs: DataFrame, source_col: str) -> DataFrame:
    rows = docs.select("doc_id", F.col(source_col).cast("string").alias("source"), _key().alias("key"), tokens_of().alias("n_tokens"))
    return stored(rows, "mixing-rows")


def report(
    docs: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: float | None = None,
    source_col: str = "source",
) -> DataFrame:
    """One row per document and epoch of the mix: source, epoch, block, the block's place, tokens."""
    rows = _rows(docs, source_col)
    schedule = Schedule(rows.select("source", "key", "n_tokens"), target_entropy, max_repeats, budget)
    found = schedule.repeated(rows.withColumn("__source", F.col("source")).withColumn("__key", F.col("key")))
    names = [F.col(f"__{c}").alias(c) for c in ("epoch", "block", "place")]
    return found.select("doc_id", "source", *names, "n_tokens")


def mix(
    docs: DataFrame,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: float | None = None,
    source_col: str = "source",
) -> DataFrame:
    """``docs`` repeated to the mix, with the same columns and in the mix's order.

    Every source is spread evenly over the whole: its epochs follow one another,
    each with its blocks in the epoch's permuted order.  The partitions are
    ranges of that order, so files written from them carry it.
    """
    rows = _rows(docs, source_col)
    schedule = Schedule(rows.select("source", "key", "n_tokens"), target_entropy, max_repeats, budget)
    keyed = docs.withColumn("__source", F.col(source_col).cast("string")).withColumn("__key", _key())
    # the key divides blocks whose rows would not fit one range
    order = ["__progress", "__source", "__epoch", "__key"]
    return schedule.repeated(keyed).repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
