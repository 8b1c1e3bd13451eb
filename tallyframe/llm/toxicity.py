"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled text train a linear classifier. The risk of calling unlabelled text
clean is corrected by the share of toxic documents that it holds, and kept from going below zero, so
that the classifier does not learn to call all positives it has not been told about clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import sampled, table, written

#: Rows of each kind that the weights are fitted on, at most, chosen by hash; features of fewer documents, of all, are left out.
POSITIVES, UNLABELLED, RARE = 3_000, 9_000, 6
#: Lengths of word beginnings.
STEMS = (4, 5, 7)
#: Places that features are hashed to: the bound of what a task sends, of what is learned, and of what is broadcast.
WIDTH = 1 << 21
#: Bits of the filter that tells which documents may be positive.
FILTER = 1 << 25
#: Bytes that part words: all but letters, digits and bytes of other scripts.
OCTETS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> set[bytes]:
    """The distinct words of a whole text, in small letters."""
    return set(text.lower().encode("utf-8", "surrogatepass").translate(OCTETS).split())


def places_of(words: list[bytes]) -> np.ndarray:
    """Places of the features of each word, a row each: itself, and how it begins, so that inflected forms are known by their
    stem. -1 where a word is no longer than the beginning would be."""
    out = np.full((len(words), 1 + len(STEMS)), -1, np.int64)
    out[:, 0] = np.fromiter(map(crc32, words), np.int64, len(words)) % WIDTH
    # The longest beginning and one more letter, of four bytes at most each. No word holds a zero byte.
    wide = 4 * (max(STEMS) + 1)
    octets = np.array(words, f"S{wide}").view(np.uint8).reshape(-1, wide)
    letter = np.cumsum((octets & 0xC0 != 0x80) & (octets > 0), axis=1)
    powers = np.cumprod(np.full(wide, 0x9E3779B97F4A7C15, np.uint64))
    terms = (octets.astype(np.uint64) + np.uint64(1)) * powers * (octets > 0)
    for column, length in enumerate(STEMS, 1):
        sums = (terms * (letter <= length)).sum(axis=1, dtype=np.uint64)
        sums = (sums ^ sums >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        out[:, column] = np.where(letter[:, -1] > length, (sums >> np.uint64(32)).astype(np.int64) % WIDTH, -1)
    return out


def hashes_of(word: bytes) -> list[int]:
    return [p for p in places_of([word])[0].tolist() if p >= 0]


class Numbers(dict):
    """Words, numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Features:
    """Places of the words of texts, worked out once for each word; forgets all when it has grown.

    ``used`` gives places other numbers, or -1 for those that are left out."""

    def __init__(self, used: np.ndarray | None = None, most: int = 400_000):
        self.used, self.most = used, most
        self.numbers, self.places = Numbers(), np.zeros((0, 1 + len(STEMS)), np.int32)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row and place of every feature of some texts, each once per text, in order."""
        if len(self.numbers) > self.most:
            self.numbers, self.places = Numbers(), self.places[:0]
        ids = []
        for text in texts:
            words = words_of(text)
            ids.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        if fresh := list(islice(self.numbers, len(self.places), None)):
            places = places_of(fresh)
            if self.used is not None:
                places = np.where(places >= 0, self.used[places], -1)
            self.places = np.concatenate([self.places, places.astype(np.int32)])
        found = self.places[np.concatenate([*ids, np.zeros(0, np.int64)])]
        row = np.repeat(np.arange(len(texts)), [len(x) for x in ids])[:, None] * WIDTH + found
        # Sorting is far faster than numpy's unique, which hashes.
        keys = np.sort(row[found >= 0])
        keys = keys[np.diff(keys, prepend=-1) > 0]
        return keys // WIDTH, keys % WIDTH


def in_parts(batches: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches in parts of a few MB of text, or of one text; null is empty."""
    for batch in batches:
        texts, size, first = [], 0, 0
        for i, value in enumerate(batch.column("text")):
            texts.append(value.as_py() or "")
            size += len(texts[-1])
            if size > most or len(texts) == 500 or i == batch.num_rows - 1:
                yield batch.slice(first, len(texts)), texts
                texts, size, first = [], 0, i + 1


def nn_pu(rows: list[np.ndarray], positive: np.ndarray, prior: float, width: int, rounds: int = 400, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights (the last is the bias) under the non-negative risk with logistic loss:
    ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``. Where the second part is below zero, the step
    goes back along it."""
    weights = np.zeros(width + 1)
    weights[width] = np.log(prior / (1 - prior))
    if not positive.any() or positive.all():
        return weights
    flat = np.concatenate([np.append(r, width) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    share_p = positive / positive.sum()
    share_u = ~positive / (~positive).sum()
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, weights[flat], len(rows))
        toxic = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        as_clean = np.logaddexp(0, z)
        open_risk = (share_u - prior * share_p) @ as_clean
        # Slopes of the two losses: toxic - 1 for "toxic", toxic for "clean".
        slope = prior * share_p * (toxic - 1) + (share_u - prior * share_p) * toxic
        if open_risk < 0:
            slope = -(share_u - prior * share_p) * toxic
        gradient = np.bincount(flat, slope[row], width + 1) + decay * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def telling(p: Column, u: Column, positives: int, unlabelled: int, errors: float = 4.5) -> Column:
    """Whether a feature's share among positives (``p`` of them hold it) differs from that among unlabelled documents
    (``u`` hold it) by so many standard errors: the signed root of the likelihood ratio, which equals the difference in
    standard errors for large counts and also holds for a word of few documents where one kind is far larger.

    All others could only add noise, in proportion to a text's length."""
    n, m = float(max(1, positives)), float(max(1, unlabelled))
    share = (p + u) / F.lit(n + m)
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    ratio = part(p, share * n) + part(n - p, (1 - share) * n) + part(u, share * m) + part(m - u, (1 - share) * m)
    return 2 * ratio > errors**2


def filter_of(ids: DataFrame) -> np.ndarray:
    """The bits of the hashes of ``of``, packed: a fixed size, whatever the number of ids."""
    held = ids.select((F.pmod(F.xxhash64("of"), F.lit(FILTER)) + 1).alias("bit"))
    size = 1 << 12  # Fixed value: bytes of one bitmap of Spark.
    out = np.zeros(max(FILTER // 8, size), np.uint8)
    bitmaps = held.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    for row in bitmaps.collect():
        out[(row["bucket"] - 1) * size : row["bucket"] * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def scan(held: DataFrame, bits: np.ndarray, drawn: np.ndarray) -> DataFrame:
    """One pass over (id, text): how many rows hold each place (``place``, ``n``; place -1 counts all rows), a sum per
    task; and ``places`` of the rows whose id the filter ``bits`` or the hashes ``drawn`` let through, with their id and the
    hash ``h`` of their text."""
    rows = held.select("id", "text", F.xxhash64("id").alias("key"), F.xxhash64("text").alias("h"))
    layout = T.StructType([held.schema["id"]]).add("h", "long").add("places", T.ArrayType(T.IntegerType())).add("place", "integer").add("n", "long")
    shared = held.sparkSession.sparkContext.broadcast((bits, drawn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, drawn = shared.value
        features, sums, rows, kind = Features(), np.zeros(WIDTH, np.int64), 0, None
        for part, texts in in_parts(batches):
            row, place = features.of(texts)
            np.add.at(sums, place, 1)
            rows += len(texts)
            key = part.column("key").to_numpy()
            bit = key % FILTER
            at = np.flatnonzero((bits[bit >> 3] >> (bit & 7) & 1).astype(bool) | np.isin(key, drawn))
            kind = part.schema.field("id").type
            if len(at):
                sizes = np.searchsorted(row, at, "right") - np.searchsorted(row, at)
                ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(place[np.isin(row, at)].astype(np.int32)))
                nothing = [pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int64())]
                some = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("h"), lists, *nothing], layout.names)
        if not rows:
            return
        place = np.flatnonzero(sums)
        place, number = np.append(place, -1).astype(np.int32), np.append(sums[place], rows)
        for low in range(0, len(place), 50_000):
            data = [pa.array(x[low : low + 50_000]) for x in (place, number)]
            nothing = [pa.nulls(len(data[0]), t) for t in (kind, pa.int64(), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*nothing, *data], layout.names)

    return rows.mapInArrow(run, layout)


def fit(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str) -> tuple[dict[int, float], float]:
    """Weight per place, and the bias.

    ``labels`` holds confirmed marks (1 or 0; null counts as none; of several marks of an id the largest holds). The
    class prior is the share of 1 among the marks. All texts are counted by feature in one pass, those of positives
    once more by themselves, and the rest of the counts is that of unlabelled rows (those without id too). The counts tell
    which features are used. For the weights, rows of both kinds are sampled by hash of their id up to the documented
    bounds, one text for an id, that of smallest hash (ties are the same text); negative marks are not used otherwise.

    Texts are never shuffled: what leaves the pass is a sum per place, and the places of rows that a filter of fixed size
    takes for positives or that are in the sample. The filter errs to one side, and a join by id is exact. A text of any
    length is a set of places, one with more distinct words than there are places all of them.
    """
    marks = labels.where(labels[label].isNotNull() & labels[label_id].isNotNull()).groupBy(labels[label_id].alias("marked")).agg(F.max(label).alias("mark"))
    marks = written(marks, "toxic-marks")
    n, toxic = marks.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("mark") == 1, 1)), F.lit(0))).first()
    prior = min(0.95, max(0.005, toxic / n)) if n else 0.05
    held = docs.select(docs[doc_id].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    toxic_ids = marks.where(F.col("mark") == 1).select(F.col("marked").alias("of"))

    ids = docs.select(docs[doc_id].alias("id")).where("id is not null").distinct()
    place = F.xxhash64(F.lit("sample"), "id")
    of = F.xxhash64(F.lit("sample"), "of")
    chosen = sampled(toxic_ids, of, POSITIVES, toxic).orderBy(of, "of").limit(POSITIVES)
    others = sampled(ids, place, UNLABELLED, ids.count()).join(toxic_ids, F.col("id") == F.col("of"), "left_anti")
    others = others.orderBy(place, "id").limit(UNLABELLED)
    chosen = written(chosen.select("of", F.lit(True).alias("positive")).unionAll(others.select("id", F.lit(False))), "toxic-sample")
    drawn = np.array([r[0] for r in chosen.select(F.xxhash64("of")).collect()], np.int64)

    parts = written(scan(held, filter_of(toxic_ids), drawn), "toxic-counts")
    rows = parts.where("place = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    made = parts.where("places is not null").select("id", "h", "places")
    marked = made.join(toxic_ids, F.col("id") == F.col("of"), "left_semi")
    positives = marked.count()
    p = marked.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("p"))
    sums = parts.where("place >= 0").groupBy("place").agg(F.sum("n").alias("n")).where(F.col("n") >= RARE)
    sums = sums.join(p, "place", "left").select("place", "n", F.coalesce("p", F.lit(0)).alias("p"))
    used = sums.where(telling(F.col("p"), F.col("n") - F.col("p"), positives, rows - positives)).select("place").collect()
    seen = np.array(sorted(r["place"] for r in used), np.int32)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.searchsorted(seen, np.intersect1d(x.values.to_numpy(), seen)).astype(np.int64).tobytes() for x in batch.column("places")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "positive", "h")), pa.array(found, pa.binary())], ["id", "positive", "h", "places"])

    # At most the documented number of ids.
    texts = made.join(F.broadcast(chosen), F.col("id") == F.col("of")).select("id", "positive", "h", "places")
    sample = texts.mapInArrow(kept, texts.select("id", "positive", "h", F.lit(b"").alias("places")).schema)
    # An id may repeat, with any number of texts: the one of smallest hash stands for it.
    sample = sample.groupBy("id", "positive").agg(F.min(F.struct("h", "places")).alias("row")).collect()
    sample.sort(key=lambda r: r["id"])
    found = [np.frombuffer(r["row"]["places"], np.int64) for r in sample]
    weights = nn_pu(found, np.array([r["positive"] for r in sample], bool), prior, len(seen))
    return dict(zip(seen.tolist(), weights[:-1].tolist(), strict=True)), float(weights[-1])


def score_toxicity(docs: DataFrame, text: str, model: tuple[dict[int, float], float], keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all) and ``score``, 0 to 1, for every row; null text counts as empty."""
    places = np.array(sorted(model[0]), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((places, np.array([model[0][p] for p in places.tolist()], np.float64), model[1]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights, bias = shared.value
        used = np.full(WIDTH, -1, np.int32)
        used[places] = np.arange(len(places))
        features = Features(used, most=600_000)
        for part, texts in in_parts(batches):
            row, place = features.of(texts)
            z = bias + np.bincount(row, weights[place], len(texts))
            scores = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores)], ["row", "score"])

    held = docs.select(F.struct(*(keep or docs.columns)).alias("row"), docs[text].alias("text"))
    return held.mapInArrow(score, held.select("row", F.lit(0.0).alias("score")).schema)


def held_out(doc_id: str | Column) -> Column:
    """Whether a row's labels are kept for testing; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    # Neither labels nor texts of the held-out rows are learned from.
    model = fit(docs.where(~held_out("doc_id")), "doc_id", "text", labels.where(~held_out("doc_id")), "doc_id", "toxic")
    scored = score_toxicity(docs, "text", model, keep=["doc_id"])
    return scored.select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
