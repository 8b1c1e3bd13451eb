"""Quality rules: counted rules with fixed limits, and a calibrated classifier over hashed n-grams.

Words, pairs of words and short runs of characters are counted in hashed places of fixed number. A logistic
regression learns their weights from rows that are labelled for quality; Platt's method turns scores into
probabilities, on scores of labelled rows by weights that have not seen them. Documents are scored in Arrow batches, whole
texts always; a document stays when it breaks no counted rule and its probability reaches a fixed limit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import sampled, table, written

#: Hashed places of each kind of feature: words and pairs, characters in twos, characters in threes.
PLACES, KINDS = 1 << 12, 3
FEATURES = PLACES * KINDS
#: Labelled rows that are learned from, at most, chosen by hash; parts that are scored by what the others teach.
TRAIN_ROWS, FOLDS = 3_000, 3
#: Bytes of a text whose characters are hashed at a time.
STRETCH = 1 << 18
# White space and the signs that are counted.
SPACES, SIGNS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """A document fails with fewer words, with a larger percentage of words in repeated windows, or below the probability."""

    words: int = 50
    repeats: int = 50
    probability: float = 0.5


class Ids(dict):
    """Numbers of words, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass
class Words:
    """The words of a text: distinct ones, and the place of each in them."""

    octets: bytes
    distinct: list[bytes]
    ids: np.ndarray

    @classmethod
    def of(cls, text: str) -> Words:
        octets = text.encode("utf-8", "surrogatepass")
        known, words = Ids(), octets.split()
        return cls(octets, known, np.fromiter(map(known.__getitem__, words), np.int64, len(words)))


def repeated(ids: np.ndarray) -> int:
    """Words in windows of three that occur twice or more. Pairs are numbered first, so that numbers stay exact."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    _, place, count = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    held = np.zeros(len(ids), bool)
    for shift in range(3):
        held[shift : shift + len(again)] |= again
    return int(held.sum())


def measure(words: Words, text: str) -> tuple[int, ...]:
    """The counted rules' measures, as named in ``MEASURES``."""
    octets = words.octets
    lines = [line for line in octets.split(b"\n") if line.strip()]
    spaces = len(octets) - len(octets.translate(None, SPACES))
    signs = len(octets) - len(octets.translate(None, SIGNS))
    return len(words.ids), len(text) - spaces, signs, len(lines) - len(set(lines)), repeated(words.ids)


def failed(measures: tuple[int, ...], limits: Limits) -> bool:
    n_words, repeats = measures[0], measures[4]
    return n_words < limits.words or 100 * repeats > limits.repeats * n_words


def features(words: Words) -> np.ndarray:
    """Hashed counts of a whole text: the root of each place's share of its kind, so that length does not matter."""
    counts = np.zeros((KINDS, PLACES))
    hashes = np.fromiter(map(zlib.crc32, words.distinct), np.uint64, len(words.distinct))[words.ids]
    counts[0] += np.bincount((hashes % PLACES).astype(np.int64), minlength=PLACES)
    # A word that follows itself is one feature, whatever the word.
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs[words.ids[:-1] == words.ids[1:]] = 0
    counts[0] += np.bincount((pairs >> np.uint64(52)).astype(np.int64), minlength=PLACES)
    octets = np.frombuffer(words.octets, np.uint8)
    for at in range(0, len(octets), STRETCH):
        # Two more bytes: a run that begins in this stretch may end in the next.
        some = octets[at : at + STRETCH + 2].astype(np.uint32)
        for kind in (1, 2):
            runs = some[: max(0, min(STRETCH, len(some) - kind))].copy()
            for more in range(1, kind + 1):
                runs |= some[more : more + len(runs)] << np.uint32(8 * more)
            counts[kind] += np.bincount((runs * np.uint32(2654435761)) >> np.uint32(20), minlength=PLACES)
    return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True))).ravel()


@dataclass
class Scorer:
    """Weights, and the line that makes a probability of a score."""

    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, values: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (values @ self.weights[:-1] + self.weights[-1]) + self.offset)


#: Without labels of both kinds there is nothing to learn, and the counted rules decide alone.
ACCEPT = Scorer(np.zeros(FEATURES + 1), 0.0, 40.0)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def regress(values: np.ndarray, good: np.ndarray, rounds: int = 80, rate: float = 0.5, decay: float = 1e-5) -> np.ndarray:
    """Weights of a logistic regression (the last is the bias), by Adagrad on all rows."""
    weights, squares = np.zeros(values.shape[1] + 1), np.full(values.shape[1] + 1, 1e-8)
    for _ in range(rounds):
        off = (sigmoid(values @ weights[:-1].astype(values.dtype) + weights[-1]) - good) / len(good)
        gradient = np.append(off.astype(values.dtype) @ values, off.sum()) + decay * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
    return weights


def calibrate(scores: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of Platt's line by Newton's method, with his smoothed targets."""
    n, m = good.sum(), (~good).sum()
    target = np.where(good, (n + 1) / (n + 2), 1 / (m + 2))
    rows = np.stack([scores, np.ones(len(scores))], axis=1)

    def loss(line: np.ndarray) -> float:
        z = rows @ line
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-7 * line @ line)

    line = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(rows @ line)
        gradient = rows.T @ (p - target) + 1e-6 * line
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(2)
        step, now = np.linalg.solve(curve, gradient), loss(line)
        while loss(line - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        line = line - step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(line[0], 1e-6)), float(line[1])


def learn(values: np.ndarray, good: np.ndarray) -> Scorer:
    """A scorer from labelled rows. Each part of them is scored by weights of the other parts, and these scores calibrate
    the weights of all."""
    if not good.any() or good.all():
        return ACCEPT
    # Both kinds are dealt to the parts in turn, so that each part has some where there are enough.
    part = np.empty(len(good), np.int64)
    for kind in (good, ~good):
        part[kind] = np.arange(kind.sum()) % FOLDS
    aside = np.zeros(len(good))
    for fold in range(FOLDS):
        some = part != fold
        weights = regress(values[some], good[some])
        aside[~some] = values[~some] @ weights[:-1] + weights[-1]
    return Scorer(regress(values, good), *calibrate(aside, good))


def fit(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, train_rows: int = TRAIN_ROWS) -> Scorer:
    """A scorer from the labelled documents, ``train_rows`` at most, those whose ids have the smallest hashes.

    A label above 0 is good. Null labels and null ids are no labels, and an id that is marked both ways is left out. Of several texts of
    an id the one of smallest hash stands for it. What reaches the driver is bounded by rows times ``FEATURES``."""
    marks = labels.where(labels[label].isNotNull() & labels[label_id].isNotNull()).groupBy(labels[label_id].alias("of"))
    marks = marks.agg(F.min((labels[label] > 0).cast("int")).alias("low"), F.max((labels[label] > 0).cast("int")).alias("high"))
    marks = written(marks.where("low = high").select("of", (F.col("low") > 0).alias("good")), "rules-labels")
    place = F.xxhash64(F.lit("rules"), "of")
    chosen = written(sampled(marks, place, train_rows, marks.count()).orderBy(place, "of").limit(train_rows), "rules-sample")
    # At most train_rows ids and marks.
    held = docs.select(docs[doc_id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    texts = held.join(F.broadcast(chosen), F.col("id") == F.col("of")).select("of", "good", F.xxhash64("text").alias("h"), "text")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for value in batch.column("text"):
                made = features(Words.of(value.as_py()))
                place = np.flatnonzero(made)
                data.append(place.astype(np.uint16).tobytes() + made[place].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("of", "good", "h")), pa.array(data, pa.binary())], ["of", "good", "h", "made"])

    made = texts.mapInArrow(sparse, texts.select("of", "good", "h", F.lit(b"").alias("made")).schema)
    sample = made.groupBy("of", "good").agg(F.min(F.struct("h", "made")).alias("row")).orderBy(place, "of").collect()
    values = np.zeros((len(sample), FEATURES), np.float32)
    for i, row in enumerate(sample):
        data = row["row"]["made"]
        half = len(data) // 2
        values[i, np.frombuffer(data[:half], np.uint16)] = np.frombuffer(data[half:], np.float16)
    return learn(values, np.array([r["good"] for r in sample], bool))


def judge(docs: DataFrame, text: str, scorer: Scorer, keep: list[str] | None = None, limits: Limits = Limits()) -> DataFrame:
    """``row`` (the columns ``keep``, or all), the measures, ``base_failed``, ``probability`` and ``kept`` for every row.

    Words are parted by ASCII white space. A null text has no words; a text without words fails by their number. Lines
    without a word are no lines. Repeated rows are judged alike."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    held = docs.select(F.struct(*(keep or docs.columns)).alias("row"), docs[text].alias("text"))
    layout = T.StructType([held.schema["row"], *(T.StructField(m, T.LongType()) for m in MEASURES)])
    layout = layout.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted, fails, sure = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = Words.of(text)
                counted.append(measure(words, text))
                fails.append(failed(counted[-1], limits))
                sure.append(float(shared.value.probability(features(words))))
            kept = [not f and p >= limits.probability for f, p in zip(fails, sure)]
            numbers = [pa.array(c, pa.int64()) for c in zip(*counted)] if counted else [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *numbers, pa.array(fails, pa.bool_()), pa.array(sure, pa.float64()), pa.array(kept, pa.bool_())], layout.names)

    return held.mapInArrow(score, layout)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = fit(docs, "doc_id", "text", labels, "doc_id", "quality")
    judged = judge(docs, "text", scorer, keep=["doc_id"])
    return judged.select("row.doc_id", *MEASURES, "base_failed", "kept", "probability")
