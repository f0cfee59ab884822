"""Language identification (2): script ranges, then Viterbi over per-word scores.

Learning counts, over all given rows, the hashed character n-grams of every
word and the words themselves by label, and the letters of every script by
label.  Tasks add up their own counts before the shuffle; the learned table
has a fixed number of slots per label, whatever the corpus.

Prediction: a word's script leaves the labels that use the script as
candidates; each candidate gets the word's mean n-gram log-likelihood times
``WEIGHT``; Viterbi with a ``PENALTY`` for changing label gives every word a
label, and equal neighbours form spans.  The label with most letters is the
text's language, and its share of the letters is the score.

Defined cases: a null text or one without letters is ``und`` with score 0 and
no spans, and so is every text if nothing was learned; ties go to the label
that sorts first; rows with a null label teach nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of the hashed n-gram table of a label (a power of two).
SLOTS = 1 << 15
#: Lengths of the character n-grams, counted with one boundary mark on each side of a word.
SIZES = (1, 2, 3, 4)
#: Weight of a word's mean log-likelihood (n-grams of one word are not independent).
WEIGHT = 4.0
#: Cost of changing the label between two words.
PENALTY = 8.0
SMOOTHING = 0.5
#: Share of its letters from which a label counts as using a script.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Distinct words of a label that a counting task holds, and words whose features are made together.
HELD_WORDS = 100_000
STEP_WORDS = 1 << 14
#: Characters labelled together.
STEP_CHARS = 6_000_000

#: First code point of each script block and the script's number
#: (Unicode ranges of letters; 0 is any other).
SCRIPTS = (
    (0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7),
    (0x0980, 8), (0x0A00, 9), (0x0A80, 10), (0x0B00, 0), (0x0B80, 11), (0x0C00, 12), (0x0C80, 13), (0x0D00, 14),
    (0x0D80, 0), (0x0E00, 15), (0x0E80, 0), (0x10A0, 16), (0x1100, 17), (0x1200, 18), (0x1380, 0), (0x1E00, 1),
    (0x1F00, 2), (0x2000, 0), (0x3040, 19), (0x3100, 0), (0x3400, 20), (0xA000, 0), (0xAC00, 17), (0xD7B0, 0),
)
N_SCRIPTS = 21
_STARTS = np.array([a for a, _ in SCRIPTS])
_NUMBERS = np.array([b for _, b in SCRIPTS])

_WORD = re.compile(r"[^\W\d_]+")

LABELLED = T.StructType([
    T.StructField("lang", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType()),
    ]))),
])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, first slot of each word, script of each word) of non-empty words."""
    points = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le"), np.uint32).astype(np.uint64)
    opens = np.flatnonzero(points == 2)
    closes = np.flatnonzero(points == 3)
    of = np.repeat(np.arange(len(words)), closes - opens + 1)
    slots, owners = [], []
    rolling = np.zeros(len(points), np.uint64)
    for n in range(1, max(SIZES) + 1):
        grams = len(points) - n + 1
        if grams <= 0:
            break
        rolling = rolling[:grams] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        same = of[:grams] == of[n - 1 :]
        if n == 1:
            same &= points > 3
        if n in SIZES:
            slots.append(rolling[same] >> np.uint64(7))
            owners.append(of[:grams][same])
    weights = points * (np.arange(len(points), dtype=np.uint64) - opens[of].astype(np.uint64) + np.uint64(1))
    mixed = points * points * np.uint64(0xC2B2AE3D27D4EB4F) + weights * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    whole = np.add.reduceat(mixed * np.uint64(0xFF51AFD7ED558CCD), opens)
    slots.append(whole)
    owners.append(np.arange(len(words)))
    all_slots, all_owners = np.concatenate(slots), np.concatenate(owners)
    all_slots = ((all_slots ^ (all_slots >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(49)
    order = np.argsort(all_owners, kind="stable")
    first = np.searchsorted(all_owners[order], np.arange(len(words)))
    scripts = _NUMBERS[np.searchsorted(_STARTS, points[opens + 1].astype(np.int64), side="right") - 1]
    return (all_slots[order] & np.uint64(SLOTS - 1)).astype(np.int64), first, scripts


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}

    def add(label: str, seen: Counter) -> None:
        own = totals.setdefault(label, np.zeros(SLOTS + N_SCRIPTS))
        words = list(seen)
        times = np.fromiter(seen.values(), np.float64, len(seen))
        for at in range(0, len(words), STEP_WORDS):
            part, n = words[at : at + STEP_WORDS], times[at : at + STEP_WORDS]
            slots, first, scripts = features(part)
            sizes = np.diff(np.r_[first, len(slots)])
            own[:SLOTS] += np.bincount(slots, np.repeat(n, sizes), SLOTS)
            letters = n * np.fromiter(map(len, part), np.float64, len(part))
            own[SLOTS:] += np.bincount(scripts, letters, N_SCRIPTS)

    counts: dict[str, Counter] = {}
    for batch in batches:
        for label, text in zip(batch.column(0), batch.column(1)):
            seen = counts.setdefault(label.as_py(), Counter())
            seen.update(_WORD.findall(text.as_py().lower()))
            if len(seen) >= HELD_WORDS:
                add(label.as_py(), counts.pop(label.as_py()))
    for label, seen in counts.items():
        add(label, seen)
    for label, own in totals.items():
        slots = np.flatnonzero(own)
        columns = [pa.array([label] * len(slots)), pa.array(slots), pa.array(own[slots])]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "slot", "n"])


@dataclass
class Model:
    labels: list[str]
    scores: np.ndarray  # [slot, label], log-likelihood
    uses: np.ndarray  # [script, label], whether the label uses the script


def learn(rows: DataFrame, label_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from every row with a label and a text."""
    rows = rows.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(_count_batches, "lang string, slot long, n double")
    # (labels x slots) rows: a size fixed by the label set, not by the corpus
    table = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = table.column("lang").to_pylist()
    labels = sorted(set(names))
    at = {label: i for i, label in enumerate(labels)}
    full = np.zeros((SLOTS + N_SCRIPTS, len(labels)))
    full[table.column("slot").to_numpy(), [at[x] for x in names]] = table.column("n").to_numpy()
    grams, letters = full[:SLOTS], full[SLOTS:]
    scores = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * SLOTS))
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    uses[~uses.any(axis=1)] = True
    return Model(labels, scores.astype(np.float32), uses)


def viterbi(scores: np.ndarray, steps: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best labels of many sequences at once.

    ``steps`` holds the score row of every step, sequence after sequence, and
    ``lengths`` the sequences' lengths.  All sequences advance together.
    """
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), side="right")
    changed = np.zeros((len(steps), scores.shape[1]), bool)
    source = np.zeros(len(steps), np.int16)
    best = scores[steps[starts[: active[0]]]] if longest else None
    ends = np.zeros(len(sizes), np.int32)
    for t in range(1, longest + 1):
        n = active[t] if t < longest else 0
        if n < len(best):
            ends[n : len(best)] = best[n:].argmax(axis=1)
            best = best[:n]
        if not n:
            break
        at = starts[:n] + t
        top = best.argmax(axis=1)
        move = (best[np.arange(n), top] - penalty)[:, None]
        switch = move > best
        changed[at], source[at] = switch, top
        best = np.where(switch, move, best) + scores[steps[at]]
    labels = np.zeros(len(steps), np.int16)
    now = np.zeros(len(sizes), np.int32)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        ended = active[t + 1] if t + 1 < longest else 0
        now[ended:n] = ends[ended:n]
        at = starts[:n] + t
        labels[at] = now[:n]
        now[:n] = np.where(changed[at, now[:n]], source[at], now[:n])
    return labels


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """[word, label]: weighted mean log-likelihood; labels that do not use the script are out."""
    out = np.empty((len(words), len(model.labels)), np.float32)
    for at in range(0, len(words), STEP_WORDS):
        slots, first, scripts = features(words[at : at + STEP_WORDS])
        sizes = np.diff(np.r_[first, len(slots)])
        means = np.add.reduceat(model.scores[slots], first, axis=0) / sizes[:, None]
        out[at : at + STEP_WORDS] = np.where(model.uses[scripts], WEIGHT * means, -1e4)
    return out


def label_texts(model: Model, texts: list[str | None], with_spans: bool = True) -> list[tuple]:
    """(label, share of letters, spans) of every text."""
    index: dict[str, int] = {}
    steps: list[np.ndarray] = [np.zeros(0, np.int32)]
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = _WORD.findall(text.lower()) if text and model.labels else []
        counts[i] = len(found)
        steps.append(np.array([index.setdefault(w, len(index)) for w in found], np.int32))
    if not index:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    vocabulary = list(index)
    at = np.concatenate(steps)
    labels = viterbi(word_scores(model, vocabulary), at, counts)
    letters = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))[at]
    n = len(model.labels)
    owner = np.repeat(np.arange(len(texts)), counts)
    share = np.bincount(owner * n + labels, letters, len(texts) * n).reshape(-1, n)
    top, total = share.argmax(axis=1), share.sum(axis=1)
    out = []
    ends = np.cumsum(counts)
    for i, text in enumerate(texts):
        if not counts[i]:
            out.append((UNKNOWN, 0.0, []))
            continue
        spans = []
        if with_spans:
            own = labels[ends[i] - counts[i] : ends[i]]
            cut = np.flatnonzero(np.diff(own)) + 1
            first = [0, *cut.tolist()]
            last = [*(cut - 1).tolist(), len(own) - 1]
            if len(first) == 1:
                spans = [(0, len(text), model.labels[own[0]])]
            else:
                # offsets are of the text as given; lower() may lengthen a text, so words are found there again
                places = [m.span() for m in _WORD.finditer(text)]
                if len(places) == len(own):
                    spans = [(places[a][0], places[b][1], model.labels[own[a]]) for a, b in zip(first, last)]
        out.append((model.labels[top[i]], float(share[i, top[i]] / total[i]), spans))
    return out


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts of about STEP_CHARS characters together, which bounds what is labelled at a time."""
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text or "")
        if held >= STEP_CHARS:
            yield some
            some, held = [], 0
    if some:
        yield some


def labeller(spark, model: Model, with_spans: bool = True):
    """A column function text -> (lang, score, spans)."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(LABELLED)
    def labelled(texts: pa.Array) -> pa.Array:
        rows = [row for some in _portions(texts.to_pylist()) for row in label_texts(held.value, some, with_spans)]
        kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))]
        spans = [[{"start": a, "end": b, "lang": c} for a, b, c in r[2]] for r in rows]
        columns = [[r[0] for r in rows], [r[1] for r in rows], spans]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], LABELLED.names)

    return labelled


def predict(docs: DataFrame, model: Model, as_col: str = "found", text_col: str = "text", with_spans: bool = True) -> DataFrame:
    """``docs`` with a struct column (lang, score, spans)."""
    return docs.withColumn(as_col, labeller(docs.sparkSession, model, with_spans)(F.col(text_col)))


def learned_rows(docs: DataFrame) -> DataFrame:
    """The documents a model may learn from: a label, and crc32(doc_id) mod 5 is not 0."""
    from fundscope.llm.common import id_crc

    return docs.where(id_crc() % 5 != 0)


def report(docs: DataFrame) -> DataFrame:
    """Per document: whether it was held out, predicted language, score, number of spans."""
    from fundscope.llm.common import id_crc

    found = predict(docs.select("doc_id", "text"), learn(learned_rows(docs)))
    return found.select(
        "doc_id",
        (id_crc() % 5 == 0).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.size("found.spans").cast("long").alias("n_spans"),
    )


def accepted(docs: DataFrame, model: Model, languages: list[str] | None = None, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is known (and asked for), with the same columns."""
    found = predict(docs, model, as_col="__found", with_spans=False)
    ok = (F.col("__found.lang") != UNKNOWN) & (F.col("__found.score") >= min_score)
    if languages is not None:
        ok &= F.col("__found.lang").isin(languages)
    return found.where(ok).select(*docs.columns)
