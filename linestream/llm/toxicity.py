"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, linear.

A feature is the number of a text's different words that hold an n-gram (3 to 5
characters, word borders included), hashed into `TABLE` slots. Over all
labelled rows the features are summed by label, and a slot's ratio is the log
of its odds in toxic texts over the odds of the label itself, both smoothed.
A logistic regression is then fitted to the scaled features of a bounded,
balanced sample of the labelled rows, each weighted by what it stands for.

A text's score is a sum over its different words, so scoring needs one number
per word (cached by word) and never builds a vector.

Sizes: a task keeps words until `WORD_CACHE` and then folds them into its
slots; the summed table has `TABLE` rows at most, the sample 2 x `SAMPLE` rows,
whatever the input. The labels (id and label) are broadcast to the texts only
up to a checked number of rows; beyond it both sides are shuffled by id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import checked_broadcast
from .common import text_or_empty, written

#: Slots for hashed n-grams, and the lengths of the n-grams.
TABLE = 1 << 18
ORDERS = (3, 4, 5)
#: Labelled rows of each label that the regression is fitted to, at most.
SAMPLE = 1000
#: Smoothing of the log-count ratios (pseudo-counts, shared out as the labels are).
ALPHA = 2.0
#: Weight of the squared coefficients, and steps of the fit.
RIDGE, STEPS = 0.03, 100
#: Different words a Python worker keeps with their scores (or counts).
WORD_CACHE = 500_000
#: A text is called toxic from this score on.
TOXIC_FROM = 0.3
#: Rows whose crc32(id as text) leaves this remainder are held out of learning.
FOLDS, HELD_OUT = 4, 2

_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    """The different lower-cased words of a text."""
    return set(_WORDS.findall(text.lower())) if text else set()


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word number and slot of every n-gram inside the bordered words."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    code = np.frombuffer(("\2" + "\3\2".join(words) + "\3").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    owners, slots = [], []
    for n in ORDERS:
        m = max(len(code) - n + 1, 0)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = (h ^ code[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = word[:m] == word[n - 1:n - 1 + m]
        owners.append(word[:m][inside])
        slots.append((h[inside] >> np.uint64(40)).astype(np.int64) % TABLE)
    return np.concatenate(owners), np.concatenate(slots)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text and how many of its different words hold each."""
    words = list(words_of(text))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(ngrams(words)[1], return_counts=True)


# ---------------------------------------------------------------- learning


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's feature sums: slot, toxic, clean."""
    seen = (Counter(), Counter())
    total = np.zeros((2, TABLE), np.int64)

    def fold() -> None:
        for label, counter in enumerate(seen):
            if counter:
                owner, slot = ngrams(list(counter))
                n = np.fromiter(counter.values(), np.int64, len(counter))
                total[label] += np.bincount(slot, weights=n[owner], minlength=TABLE).astype(np.int64)
                counter.clear()

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[label].update(words_of(text))
            if len(seen[0]) + len(seen[1]) > WORD_CACHE:
                fold()
    fold()
    at = np.flatnonzero(total.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[1][at]), pa.array(total[0][at])],
                                     names=["slot", "toxic", "clean"])


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s.astype("<i4").tobytes() for s, _ in found], pa.binary()),
             pa.array([np.minimum(n, 0xFFFF).astype("<u2").tobytes() for _, n in found], pa.binary())], names=["label", "slots", "counts"])


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Log odds of toxic for each slot over those of all features; 0 for an unseen slot."""
    share = toxic.sum() / max(toxic.sum() + clean.sum(), 1)
    if not 0 < share < 1:
        return np.zeros(len(toxic), np.float32)
    odds = np.log((toxic + ALPHA * share) / (clean + ALPHA * (1 - share)))
    return (odds - np.log(share / (1 - share))).astype(np.float32)


def fit(slots: list[np.ndarray], counts: list[np.ndarray], label: np.ndarray, weight: np.ndarray,
        ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by slot (coefficient times ratio) and the constant, by gradient steps with momentum."""
    row = np.repeat(np.arange(len(label), dtype=np.int32), [len(s) for s in slots])
    at = np.concatenate(slots)
    x = np.concatenate(counts).astype(np.float32) * ratios[at]
    weight = weight / weight.sum()
    rate = float((weight * label).sum())
    beta = np.zeros(len(ratios))
    constant = np.log(rate / (1 - rate))
    m, v, m0, v0 = np.zeros(len(ratios)), np.zeros(len(ratios)), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = np.bincount(row, weights=x * beta.astype(np.float32)[at], minlength=len(label)) + constant
        error = weight * (sigmoid(z) - label)
        g = np.bincount(at, weights=x * error.astype(np.float32)[row], minlength=len(ratios)) + RIDGE * beta
        g0 = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        m0, v0 = 0.9 * m0 + 0.1 * g0, 0.99 * v0 + 0.01 * g0 * g0
        step, a, b = 0.1 * (1 - 0.9 * t / STEPS), 1 - 0.9 ** t, 1 - 0.99 ** t
        beta -= step * (m / a) / (np.sqrt(v / b) + 1e-6)
        constant -= step * (m0 / a) / (np.sqrt(v0 / b) + 1e-6)
    return (beta * ratios).astype(np.float32), float(constant)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def labelled(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """_id, _toxic of every id that has a label: 1 if any of its label rows says 1."""
    rows = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
    return (rows.groupBy(F.col(f"`{id_col}`").cast("long").alias("_id"))
            .agg(F.max((F.col(f"`{label_col}`").cast("double") >= 0.5).cast("int")).alias("_toxic")))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict | None:
    """Model from all rows of `docs` whose id has a label. None without any
    labelled row; with one label only, the constant answer."""
    spark = docs.sparkSession
    # ids and labels only; beyond the checked size the texts meet them in a shuffle
    marked, _small = checked_broadcast(labelled(labels, id_col, label_col))
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id")).join(marked, "_id")
    # a row each for the labels: how many rows, and the hash below which SAMPLE ids lie
    sizes = {r["_toxic"]: r["n"] for r in ids.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    if len(sizes) == 1:
        return {"weights": None, "constant": 60.0 if 1 in sizes else -60.0}
    rows = (docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_or_empty(text_col).alias("text"))
            .join(marked, "_id"))
    sums = rows.select("_toxic", "text").mapInArrow(_count, "slot int, toxic long, clean long")
    table = sums.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()
    toxic, clean = np.zeros(TABLE), np.zeros(TABLE)
    toxic[table["slot"]], clean[table["slot"]] = table["toxic"], table["clean"]
    ratios = log_count_ratios(toxic, clean)
    pick = F.xxhash64(F.col("_id"), F.lit(7))
    chosen = [ids.where(F.col("_toxic") == label).select("_id", "_toxic").distinct().orderBy(pick, "_id").limit(SAMPLE) for label in (0, 1)]
    chosen = written(chosen[0].unionByName(chosen[1]), "op11-sample")  # 2 x SAMPLE ids at most: the broadcast's bound
    texts = (docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_or_empty(text_col).alias("text"))
             .join(F.broadcast(chosen), "_id").select("_toxic", "text").distinct())
    got = texts.mapInArrow(_featurize, "label int, slots binary, counts binary").limit(4 * SAMPLE).toArrow()
    label = np.array(got["label"].to_pylist(), np.float64)
    slots = [np.frombuffer(b, "<i4") for b in got["slots"].to_pylist()]
    counts = [np.frombuffer(b, "<u2") for b in got["counts"].to_pylist()]
    if not any(len(s) for s in slots):
        return {"weights": None, "constant": float(np.log((sizes[1] + 0.5) / (sizes[0] + 0.5)))}
    per = {y: sizes[y] / max((label == y).sum(), 1) for y in (0, 1)}
    weights, constant = fit(slots, counts, label, np.where(label == 1, per[1], per[0]), ratios)
    return {"weights": weights, "constant": constant}


# ---------------------------------------------------------------- scoring


class Scorer:
    """Scores of texts as sums over their different words, cached by word."""

    def __init__(self, model: dict):
        self.weights, self.constant = model["weights"], model["constant"]
        self.words: dict[str, float] = {}

    def logit(self, text: str | None) -> float:
        if self.weights is None:
            return self.constant
        words = words_of(text)
        known = self.words
        if new := [w for w in words if w not in known]:
            if len(known) + len(new) > WORD_CACHE:
                known.clear()
                new = list(words)
            owner, slot = ngrams(new)
            known.update(zip(new, np.bincount(owner, weights=self.weights[slot], minlength=len(new)).tolist(), strict=True))
        return self.constant + math.fsum(map(known.__getitem__, words))  # exact, so a set's order does not matter


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = sigmoid(np.array([scorer.logit(t) for t in batch.column(1).to_pylist()], np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["_id", "score"])
    return run


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id`, score of every row; 0 for every row if nothing was learned."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_or_empty(text_col).alias("text"))
    if model is None:
        return rows.select("_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TABLE floats
    return rows.mapInArrow(_scored(shared), "_id long, score double")


def _held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from `TOXIC_FROM` on).

    One row per input row. Learned from the labelled rows that are not held
    out; the labels, and all other columns, are no input of a score. A null or
    empty text, or one without a word, gets the model's constant. A null id is
    not held out and has no label; an id with several label rows is toxic if
    one says so; null labels are not read. Repeated rows get the same score.
    Whole texts are read, however long: memory follows their different words.
    Without any labelled row every score is 0; with one label only it is that
    label's.
    """
    train = docs.where(~_held_out(id_col))
    out = score(docs, learn(train, labels, id_col, text_col, label_col), id_col, text_col)
    return out.select(F.col("_id").alias("doc_id"), _held_out("_id").alias("held_out"), "score",
                      (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
