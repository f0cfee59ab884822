"""Toxicity (7): a counterfactual-regularised classifier.

A text's features are the words it contains and their first 4 to 8 letters.
Learning, from labelled rows only:

1. Of the labelled texts with equal label and equal words in equal order (copies,
   up to capitals and punctuation) one teaches, so that a copied text has one
   vote; texts that differ in any word all teach.
2. Document counts of all features by label, over all teaching texts, are
   added up in the tasks and then by a shuffle; the ``FEATURES`` most telling
   ones (log-likelihood ratio, more frequent in toxic texts) are kept, and the
   identity terms always.
3. Logistic weights, not negative, are fitted on at most ``FIT_ROWS`` teaching
   texts of each label (lowest hash first, weighted to the full label counts),
   with an L1 penalty and the counterfactual one: in each text that names a
   group, the term is swapped for another of its group, and the squared change
   of the log-odds is penalised.  A term that merely occurs in toxic texts
   thus keeps no weight of its own.

Scoring reads whole texts; a text without features has the base score.

Defined cases: null and empty texts get the base score; rows without a label
teach nothing; several labels of one id count as toxic if any is; without any
toxic (or any other) teaching text all scores are the smoothed label share;
repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import binary_list, id_crc, stored
from fundscope.llm.decontam import words

FEATURES = 8192
MIN_TEXTS = 2
#: Teaching texts of each label that the weights are fitted on.
FIT_ROWS = 8000
PREFIXES = (4, 5, 6, 7, 8)
L1 = 2e-4
L2 = 1e-4
COUNTERFACTUAL = 1.0
ROUNDS = 400
THRESHOLD = 0.7
#: Features that a counting task holds before it hands them on.
HELD_FEATURES = 400_000

#: Neutral terms for groups of people; terms of one line are swapped for one another.
IDENTITY_TERMS = (
    "women men girls boys female male frauen männer femmes hommes mujeres hombres",
    "gay lesbian straight bisexual transgender queer heterosexual schwule lesben homosexuels homosexuales",
    "muslim christian jewish hindu buddhist atheist catholic muslime christen juden musulmans chrétiens juifs "
    "musulmanes cristianos judíos",
    "black white asian latino african european american schwarze weiße noirs blancs negros blancos",
    "immigrants refugees foreigners natives migranten flüchtlinge immigrés réfugiés inmigrantes refugiados",
    "old young elderly teenagers alte junge vieux jeunes viejos jóvenes",
    "blind deaf disabled autistic behinderte handicapés discapacitados",
)


def feature_set(text_words: set[str]) -> set[str]:
    """The words, and as ``abcd*`` their beginnings."""
    out = set(text_words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in text_words if len(w) > n])
    return out


def word_set(text: bytes | None) -> set[str]:
    return _set_of(b" ".join(words(text)))


def _set_of(joined: bytes) -> set[str]:
    return set(joined.decode().split(" ")) - {""}


def _copy_key(joined: bytes) -> int:
    """A signed 64-bit name of all words of a text, in order."""
    return xxhash.xxh64_intdigest(joined) - (1 << 63)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        joined = [b" ".join(words(t)) for t in binary_list(batch.column(1))]
        keys = [_copy_key(j) for j in joined]
        text = pa.array([" ".join(_set_of(j)) for j in joined], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), text], names=["doc_id", "key", "words"])


def teaching_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, key, words): one text per label and copy key.

    Labels and copies meet as ids and keys; the words cross one exchange, copies within a task once.
    """
    rows = stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _word_batches, "doc_id long, key long, words string"), "toxicity-words", "zstd")
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    pairs = rows.select("doc_id", F.col("key").alias("k")).join(known, F.col("doc_id") == F.col("id"))
    marks = pairs.groupBy("k").agg(F.collect_set("toxic").alias("marks"))
    # equal keys have equal words, whichever text they are read from
    texts = rows.groupBy("key").agg(F.min("words").alias("words"))
    taught = texts.join(marks, F.col("key") == F.col("k"))
    return stored(taught.select(F.explode("marks").alias("toxic"), "key", "words"), "toxicity-taught", "zstd")


def fit_rows(taught: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of each label with the lowest (h, key); bounds are found on keys, so no words are moved."""
    rows = taught.withColumn("h", F.xxhash64("key"))
    h, key, wanted = F.col("h"), F.col("key"), F.lit(False)
    for y in (0, 1):
        lowest = rows.where(F.col("toxic") == y).select("h", "key").orderBy("h", "key").limit(most)
        last = lowest.agg(F.max(F.struct("h", "key")).alias("last")).first()["last"]
        if last:
            wanted |= (F.col("toxic") == y) & ((h < last["h"]) | ((h == last["h"]) & (key <= last["key"])))
    return rows.where(wanted)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def given(counts: dict) -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([counts[t][x] for x in names], pa.int64()) for t in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, names=["feature", "n1", "n0"])

    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update(feature_set(set(text.split(" ")) - {""}))
            if len(counts[0]) + len(counts[1]) > HELD_FEATURES:
                yield given(counts)
                counts = {0: Counter(), 1: Counter()}
    yield given(counts)


def _identity_groups() -> list[list[str]]:
    return [line.split() for line in IDENTITY_TERMS]


@dataclass
class Model:
    weights: dict[str, float]
    base: float

    def score(self, text: bytes | None) -> float:
        have = feature_set(word_set(text))
        known = self.weights
        x = self.base + math.fsum(known[f] for f in have if f in known)
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def swapped(have: list[int], groups: list[list[list[int]]], turn: int) -> list[int]:
    """The feature numbers after each identity term is swapped for another of its line."""
    out = set(have)
    for line in groups:
        present = [i for i, term in enumerate(line) if term[0] in out]
        for i in present:
            out -= set(line[i])
        for i in present:
            out |= set(line[(i + 1 + turn % (len(line) - 1)) % len(line)])
    return sorted(out)


def fit(
    rows: list[tuple[int, list[int]]],
    n_features: int,
    totals: tuple[int, int],
    groups: list[list[list[int]]],
    counterfactual: float = COUNTERFACTUAL,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, float]:
    """Non-negative weights and the base, by proximal steps scaled per feature.

    ``rows``: (label, feature numbers); ``totals``: all texts of label 0 and 1.
    """
    label = np.array([y for y, _ in rows], float)
    sizes = np.array([len(x) for _, x in rows])
    column = np.fromiter((j for _, x in rows for j in x), np.int64, sizes.sum())
    row = np.repeat(np.arange(len(rows)), sizes)
    share = [totals[y] / max(1.0, (label == y).sum()) for y in (0, 1)]
    weight = np.where(label == 1, share[1], share[0]) / sum(totals)
    pairs = [(i, x, swapped(x, groups, i)) for i, (_, x) in enumerate(rows)]
    pairs = [(i, sorted(set(x) - set(z)), sorted(set(z) - set(x))) for i, x, z in pairs if x != z]
    moved = np.array([(k, j, s) for k, (_, a, b) in enumerate(pairs) for s, f in ((1, a), (-1, b)) for j in f], float).reshape(-1, 3)
    pair, feature, sign = moved[:, 0].astype(int), moved[:, 1].astype(int), moved[:, 2]
    own = counterfactual * np.array([weight[i] for i, _, _ in pairs])
    per_row = np.bincount(row, minlength=len(rows))
    per_pair = np.bincount(pair, minlength=len(pairs))
    scale = np.bincount(column, (0.25 * weight * (per_row + 1))[row], n_features) + L2 + 1e-9
    scale += np.bincount(feature, (2 * own * per_pair)[pair], n_features) if len(pairs) else 0
    base_scale = float((0.25 * weight * (per_row + 1)).sum())
    w, base = np.zeros(n_features), math.log((totals[1] + 0.5) / (totals[0] + 0.5))
    ahead, ahead_base, t = w.copy(), base, 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(row, ahead[column], len(rows)) + ahead_base)))
        wrong = weight * (p - label)
        gradient = np.bincount(column, wrong[row], n_features) + L2 * ahead
        if len(pairs):
            change = np.bincount(pair, sign * ahead[feature], len(pairs))
            gradient += np.bincount(feature, 2 * (own * change)[pair] * sign, n_features)
        w_next = np.maximum(0, ahead - (gradient + L1) / scale)
        base_next = ahead_base - wrong.sum() / base_scale
        if (ahead - w_next) @ (w_next - w) + (ahead_base - base_next) * (base_next - base) > 0:
            t = 1.0  # the momentum points uphill
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = w_next + (t - 1) / t_next * (w_next - w)
        ahead_base = base_next + (t - 1) / t_next * (base_next - base)
        w, base, t = w_next, base_next, t_next
    return w, base


def learn(docs: DataFrame, labels: DataFrame, counterfactual: float = COUNTERFACTUAL) -> Model:
    """``docs``: the rows that may teach; ``labels``: (doc_id, toxic)."""
    spark = docs.sparkSession
    taught = teaching_rows(docs, labels)
    found = {r["toxic"]: r["count"] for r in taught.groupBy("toxic").count().collect()}
    totals = found.get(0, 0), found.get(1, 0)
    if not all(totals):
        return Model({}, math.log((totals[1] + 0.5) / (totals[0] + 0.5)))
    counts = taught.select("toxic", "words").mapInArrow(_count_batches, "feature string, n1 long, n0 long")
    counts = counts.groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    n0, n1 = (F.lit(float(x)) for x in totals)
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    mean = (a + b) / (n1 + n0)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = part(a, mean * n1) + part(b, mean * n0) + part(n1 - a, (1 - mean) * n1) + part(n0 - b, (1 - mean) * n0)
    telling = counts.where((a * n0 > b * n1) & (a + b >= MIN_TEXTS)).withColumn("ratio", ratio)
    top = [r["feature"] for r in telling.orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()]
    lines = _identity_groups()
    terms = [f for line in lines for t in line for f in sorted(feature_set({t}))]
    names = list(dict.fromkeys([*top, *terms]))
    number = {f: i for i, f in enumerate(names)}
    groups = [[[number[t], *(number[f] for f in sorted(feature_set({t})) if f != t)] for t in line] for line in lines]
    held = spark.sparkContext.broadcast(number)

    @F.arrow_udf("array<int>")
    def numbers(texts: pa.Array) -> pa.Array:
        known = held.value
        rows = [sorted(known[f] for f in feature_set(set(t.split(" "))) if f in known) for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.int32()))

    rows = fit_rows(taught, FIT_ROWS).select("toxic", "h", "key", numbers("words").alias("x")).collect()
    chosen = [(r["toxic"], r["x"]) for r in sorted(rows, key=lambda r: (r["toxic"], r["h"], r["key"]))]
    weights, base = fit(chosen, len(names), totals, groups, counterfactual)
    return Model({names[i]: float(weights[i]) for i in np.flatnonzero(weights > 1e-6).tolist()}, float(base))


def scored(docs: DataFrame, model: Model, as_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the toxicity score of every text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([held.value.score(t) for t in binary_list(texts)], pa.float64())

    return docs.withColumn(as_col, score(F.col(text_col)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, score, and whether it is predicted toxic."""
    model = learn(docs.where(id_crc() % 3 != 1).select("doc_id", "text"), labels.select("doc_id", "toxic"))
    found = scored(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", (id_crc() % 3 == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
