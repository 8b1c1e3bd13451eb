"""Quality classifier from weak labels.

Heuristic labellers vote on every document: good, bad, or no opinion. Expectation-maximisation finds how
far each labeller can be trusted, from how often the vote patterns occur in the whole corpus; no hand-made
label is used. The posterior of a document's pattern then trains a linear scorer over hashed
features, which also judges what the labellers leave open.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import below, table, written

#: Hash space of features; rows the scorer is trained on, at most, chosen by hash; score from which a document stays.
FEATURES, TRAIN_ROWS, KEEP = 1 << 14, 12_000, 0.5
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
SYMBOLS = b"!#$%&*+/<=>@[\\]^_`{|}~"
#: Words up to this length are remembered with their shape; longer ones are looked at anew.
REMEMBERED = 64


class Kinds(dict):
    """Kind of a character, for ``str.translate``: upper case, other letter or mark, number, or the character itself."""

    def __missing__(self, code: int) -> str:
        category = unicodedata.category(chr(code))
        self[code] = kind = "A" if category == "Lu" else "a" if category[0] in "LM" else "0" if category[0] == "N" else chr(code)
        return kind


class Shapes(dict):
    """Shape of a word, all of it: its kinds of characters in the order they first occur, with ``+`` where one comes
    back after another. A text without spaces is one word, however long."""

    kinds = Kinds()

    def __missing__(self, word: str) -> str:
        mapped = word.translate(self.kinds)
        once = "".join(dict.fromkeys(mapped))
        # Kinds that come back begin more runs than there are kinds.
        runs = len(mapped) - sum(map(eq, mapped, mapped[1:]))
        shape = once if runs == len(once) else once + "+"
        if len(word) <= REMEMBERED:
            self[word] = shape
        return shape


def measures(text: str) -> dict[str, float]:
    """Shares and sizes of a whole text that labellers and features look at."""
    words, data = text.split(), text.encode("utf-8", "surrogatepass")
    n = max(1, len(words))
    upper, lower = (len(data) - len(data.translate(None, kind)) for kind in (UPPER, LOWER))
    lines = [line for line in text.split("\n") if line]
    counts = Counter(words)
    return {
        "words": len(words),
        "upper": upper / max(1, upper + lower),
        "symbols": (len(data) - len(data.translate(None, SYMBOLS))) / max(1, len(data)),
        "again": sum(map(eq, words, words[1:])) / n,
        "top": max(counts.values(), default=0) / n,
        "distinct": len(counts) / n,
        "bars": text.count("|") / n,
        "length": len(text) / n,
        "stops": (text.count(".") + text.count("!") + text.count("?")) / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
    }


def votes(m: dict[str, float]) -> list[int]:
    """One vote per labeller: 1 good, -1 bad, 0 no opinion. They overlap on purpose.

    Most look for one fault and have no opinion where it is absent, since junk seldom has more than one or
    two; the last three look for signs of prose.
    """
    some = m["words"] >= 8
    bad = [
        m["again"] > 0.2,
        m["upper"] > 0.45,
        m["symbols"] > 0.04,
        some and m["top"] > 0.3,
        some and m["distinct"] < 0.3,
        m["bars"] > 0.1,
        m["stops"] > 0.7,
        m["lines"] > 0.5,
        m["length"] > 14 or m["words"] == 0,
    ]
    # A few words say little about shares, so they get the benefit of the doubt.
    few = 0 < m["words"] < 30
    calm = m["symbols"] < 0.035 and m["upper"] < (0.45 if few else 0.3) and m["again"] < 0.12
    good = [
        calm and 0.01 < m["stops"] < (0.6 if few else 0.3) and m["distinct"] > 0.4,
        3 < m["length"] < (12 if few else 8) and (few or m["top"] < 0.2) and m["distinct"] > 0.4,
        calm and m["bars"] == 0,
    ]
    return [-1 if x else 0 for x in bad] + [1 if x else 0 for x in good]


LABELLERS = 12


def features(text: str, m: dict[str, float], shapes: Shapes) -> np.ndarray:
    """Hashed features: each measure's level, and the word shapes that make up a part of the text."""
    names = [f"{k}:{int(np.log2(v + 1) if k == 'words' else v if k == 'length' else min(v, 1) * 16)}" for k, v in m.items()]
    words = text.split()
    for shape, count in Counter(map(shapes.__getitem__, words)).items():
        share = count / len(words)
        if share >= 0.03:
            names.append(f"shape {shape}:{int(share * 4)}")
    return np.unique(np.fromiter((zlib.crc32(x.encode()) % FEATURES for x in names), np.int32, len(names)))


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of "good" for each vote pattern by expectation-maximisation.

    ``patterns``: a row of votes (-1, 0, 1) each; ``counts``: how many documents have it. A labeller has a
    distribution over its three answers for good and for bad documents. At the start any vote is trusted, a
    fault more than a sign of prose, which also fixes which class is which.
    """
    if not len(patterns):
        return np.zeros(0)
    good = 1 / (1 + np.exp(-1.0 - (patterns > 0).sum(axis=1) + 4.0 * (patterns < 0).sum(axis=1)))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        prior = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        log = np.log(prior)[:, None].repeat(len(patterns), 1)
        for j in range(patterns.shape[1]):
            table = np.stack([weight @ (patterns[:, j] == v) for v in (-1, 0, 1)], axis=1) + 0.5
            log = log + np.log(table / table.sum(axis=1, keepdims=True))[:, patterns[:, j] + 1]
        fresh = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done = np.abs(fresh - good).max() < 1e-6
        good = fresh
        if done:
            break
    return good


def train_linear(rows: list[np.ndarray], target: np.ndarray, rounds: int = 200, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic scorer on sets of hashed features, by Adagrad on all rows."""
    weights, squares = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    if not len(rows):
        return weights
    flat = np.concatenate([np.append(r, FEATURES) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    for _ in range(rounds):
        score = 1 / (1 + np.exp(-np.bincount(row, weights[flat], len(rows))))
        gradient = np.bincount(flat, (score - target)[row], FEATURES + 1) / len(rows) + decay * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
    return weights


_CODES = 3 ** np.arange(LABELLERS)


def fit(docs: DataFrame, text: str, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """The scorer's weights. Vote patterns are counted over all documents (at most 2^12 kinds reach the driver);
    the scorer is trained on ``train_rows`` different texts at most, those of smallest hash, with the posteriors of
    their patterns as targets. Only documents below a bound on the hash are given features; equal texts are one row of
    the sample, however many copies there are, so the bound is set from the number of different texts."""
    held = docs.select(F.coalesce(docs[text], F.lit("")).alias("text")).select("text", F.xxhash64("text").alias("h"))
    bound = below(train_rows, held.select("h").distinct().count())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            codes, made = [], []
            for value, h in zip(batch.column("text"), batch.column("h").to_pylist(), strict=True):
                text = value.as_py()
                m = measures(text)
                codes.append(int(_CODES @ (np.array(votes(m)) + 1)))
                made.append(features(text, m, shapes).tobytes() if bound is None or h < bound else None)
            if len(shapes) > 300_000:
                shapes.clear()
            columns = [batch.column("h"), pa.array(codes, pa.int32()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["h", "code", "features"])

    labelled = written(held.mapInArrow(label, "h long, code int, features binary"), "quality-votes")
    counted = np.array([tuple(r) for r in labelled.groupBy("code").count().collect()], np.int64).reshape(-1, 2)
    patterns = (counted[:, :1] // _CODES) % 3 - 1
    good = dict(zip(counted[:, 0].tolist(), label_model(patterns, counted[:, 1]).tolist(), strict=True))
    drawn = labelled.where(F.col("features").isNotNull())
    drawn = drawn.groupBy("h").agg(F.min("code").alias("code"), F.min("features").alias("features"))
    sample = drawn.orderBy("h").limit(train_rows).collect()
    return train_linear([np.frombuffer(r["features"], np.int32) for r in sample], np.array([good[r["code"]] for r in sample]))


def score_quality(docs: DataFrame, text: str, weights: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all) and ``quality``, 0 to 1, for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, shapes = shared.value, Shapes()
        for batch in batches:
            scores = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                scores.append(1 / (1 + np.exp(-weights[FEATURES] - weights[features(text, measures(text), shapes)].sum())))
            if len(shapes) > 300_000:
                shapes.clear()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "quality"])

    held = docs.select(F.struct(*(keep or docs.columns)).alias("row"), docs[text].alias("text"))
    row = held.select("row", F.lit(0.0).alias("quality")).schema
    return held.mapInArrow(score, row)


def classify(docs: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``quality`` by a scorer that is fitted on these documents.

    Null text counts as empty; an empty text is scored like any other. All measures and word shapes are those of the
    whole text, however long. Repeated rows count as often as they occur; texts that tie for the bound of the
    sample are equal ones. Further columns of any name pass. An empty table gives no rows, and a scorer that answers 0.5.
    """
    return score_quality(docs, text, fit(docs, text), keep)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    return scored.select("row.doc_id", "quality", (F.col("quality") >= KEEP).alias("kept"))
