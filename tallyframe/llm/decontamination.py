"""Benchmark decontamination: an FM-index per shard of training text, searched for test phrases.

A task reads documents, cuts them into words and indexes about a million words at a time. Words that no
phrase holds can be in no match, so they part the text into runs, and only runs as long as the shortest
phrase are indexed. All phrases of a shard are searched backward at once, through the ranks of a wavelet
matrix over the Burrows-Wheeler transform; occurrences are located from sampled suffix positions, and
their spans are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table, written

#: Words of a window, words of a shard, distance of sampled positions, and phrases per broadcast.
WINDOW, SHARD_WORDS, SAMPLE, PHRASES = 10, 1_000_000, 8, 200_000
# What a word is, on text and on its UTF-8 bytes (small letters; all that parts words as space).
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
OCTETS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(OCTETS).split()


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes in order. Symbol 0 parts runs: a suffix ends at the next 0, and equal ones go by position.

    The first key packs as many symbols as fit; then, by prefix doubling, only suffixes that are
    still tied are sorted again, by the rank of what follows.
    """
    n, width = len(text), 62 // bits
    ends = np.where(text == 0, np.arange(n), n)
    left = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(width):
        symbol = np.zeros(n, np.int64)
        symbol[: max(0, n - k)] = text[k:]
        key = (key << bits) | np.where(k < left, symbol, 0)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int64)
    reach = width
    ended = left[order] < width
    while True:
        start = np.maximum.accumulate(np.where(head | ended, np.arange(n), 0))
        rank[order] = start
        tied = np.flatnonzero(~ended & (~head | np.concatenate([~head[1:] & ~ended[1:], [False]])))
        if not len(tied):
            return order
        part = order[tied]
        again = np.lexsort((part, rank[part + reach], start[tied]))
        order[tied] = part = part[again]
        follow = rank[part + reach]
        same = np.concatenate([[False], (start[tied][1:] == start[tied][:-1]) & (follow[1:] == follow[:-1])])
        head[tied] = ~same
        ended[tied] = left[part] < 2 * reach
        reach *= 2


class WaveletMatrix:
    """Ranks over a sequence: one row of bits per bit of a symbol, with counts of ones before each word."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit) & 1
            padded = np.zeros((len(ones) // 64 + 1) * 64, np.uint8)
            padded[: len(ones)] = ones
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((bit, words, before, len(ones) - int(ones.sum())))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros(len(at), np.int64)
        for bit, words, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            low, at = (np.where(one, zeros + r, p - r) for p in (low, at) for r in [self._ones(words, before, p)])
        return at - low

    @staticmethod
    def _ones(words, before, at):
        inside = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[at >> 6] + np.bitwise_count(inside)


class FMIndex:
    """Search in runs of symbols 1 to 2**bits - 1, parted by 0."""

    def __init__(self, text: np.ndarray, bits: int, sample: int = SAMPLE):
        order = suffix_array(text, bits)
        self.last = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.ranks = WaveletMatrix(self.last, bits)
        # The walk back stops where a run begins, so those positions are kept besides every n-th.
        self.kept = (order % sample == 0) | (self.last == 0)
        self.places = order[self.kept]
        self.nth = np.cumsum(self.kept) - 1
        self.size = len(text)

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.before[symbols] + self.ranks.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each phrase; phrases are rows, padded with 0 in front."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            more = alive[phrases[alive, k] > 0]
            low[more], high[more] = self._step(phrases[more, k], low[more]), self._step(phrases[more, k], high[more])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, each walked back to a sampled one."""
        found, steps, open_ = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            done = self.kept[rows[open_]]
            at = open_[done]
            found[at] = self.places[self.nth[rows[at]]] + steps
            open_ = open_[~done]
            rows[open_] = self._step(self.last[rows[open_]], rows[open_])
            steps += 1
        return found


class Phrases:
    """Distinct phrases as rows of word codes, with the items that hold each."""

    def __init__(self, pairs: list[tuple[str, object]]):
        self.codes: dict[bytes, int] = {}
        self.items: list[list] = []
        rows, known = [], {}
        for phrase, item in pairs:
            if phrase not in known:
                known[phrase] = len(rows)
                rows.append([self.codes.setdefault(w, len(self.codes) + 1) for w in phrase.encode("utf-8", "surrogatepass").split(b" ")])
                self.items.append([])
            self.items[known[phrase]].append(item)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.longest, self.shortest = (int(self.lengths.max()), int(self.lengths.min())) if rows else (0, 0)
        self.rows = np.zeros((len(rows), self.longest), np.int64)
        for k, r in enumerate(rows):
            self.rows[k, self.longest - len(r) :] = r
        self.bits = max(1, len(self.codes).bit_length())

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and phrase of every occurrence in a shard of word codes (0: no phrase holds the word)."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes > 0, [False]])))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return none
        # Runs one after another, a 0 behind each; origin leads back to the shard.
        sizes = ends - starts + 1
        origin = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        text = codes[np.minimum(origin, len(codes) - 1)]
        text[np.cumsum(sizes) - 1] = 0
        index = FMIndex(text, self.bits)
        low, high = index.search(self.rows)
        hits = np.flatnonzero(high > low)
        counts = (high - low)[hits]
        if not len(hits):
            return none
        rows = np.repeat(low[hits] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return origin[index.locate(rows)], np.repeat(hits, counts)


def find_in_texts(texts: list[str | None], phrases: Phrases, shard_words: int = SHARD_WORDS) -> tuple[list[int], list[list], list[list]]:
    """Per text: its words, the merged word ranges that phrases cover, and the items found."""
    counts, ranges, items = [], [[] for _ in texts], [[] for _ in texts]
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def search():
        nonlocal held, size
        if held:
            starts = np.cumsum([0] + [len(c) + 1 for _, _, c in held])
            shard = np.zeros(starts[-1], np.int64)
            for at, (_, _, c) in zip(starts, held):
                shard[at : at + len(c)] = c
            places, which = phrases.find(shard)
            piece = np.searchsorted(starts, places, "right") - 1
            for p, k, place in zip(piece.tolist(), which.tolist(), (places - starts[piece]).tolist()):
                doc, offset, _ = held[p]
                ranges[doc].append((offset + place, offset + place + int(phrases.lengths[k])))
                items[doc].append(k)
        held, size = [], 0

    for doc, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        if not phrases.longest:
            continue
        codes = np.fromiter(map(phrases.codes.get, words, repeat(0)), np.int64, len(words))
        # A text longer than a shard goes in pieces that overlap by a window less one word.
        for at in range(0, max(1, len(codes) - phrases.longest + 1), shard_words):
            held.append((doc, at, codes[at : at + shard_words + phrases.longest - 1]))
            size += len(held[-1][2])
            if size >= shard_words:
                search()
    search()
    for doc, found in enumerate(ranges):
        ranges[doc] = merged(found)
        items[doc] = list({i for k in set(items[doc]) for i in phrases.items[k]})
    return counts, ranges, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order; those that overlap or touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def text_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges of a text in code points."""
    if not ranges:
        return []
    places = [m.span() for m in WORDS.finditer(text.translate(_SMALL))]
    return [(places[a][0], places[b - 1][1]) for a, b in ranges]


_SMALL = {c: c + 32 for c in range(65, 91)}
RANGE = "array<struct<start: long, end: long>>"
_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def phrase_table(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """``phrase``, ``item_id``: the windows of every item; an item of fewer words is one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                found = {b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))} if words else set()
                found = [w.decode("utf-8", "surrogatepass") for w in sorted(found)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([item] * len(found), pa.string())], ["phrase", "item_id"])

    return items.select(items[item_id].cast("string").alias("item_id"), items[text].alias("text")).mapInArrow(cut, "phrase string, item_id string")


def find_contamination(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str, keep: list[str] | None = None, window: int = WINDOW, block: int = PHRASES) -> DataFrame:
    """``row`` (the columns ``keep`` of docs, or all), ``n_words``, ``n_hit``, ``words`` (merged word ranges that
    windows of items cover), ``spans`` (the same in code points, for removal) and ``items`` (ids as strings).

    Phrases are broadcast in blocks of bounded number; each block is a pass over the documents that writes
    what it found for the next. Null or empty texts have no words; items without words match nothing, and
    with no items nothing is hit. A null item id counts as item "". Repeated rows are searched each.
    """
    spark = docs.sparkSession
    phrases = written(phrase_table(items, item_id, item_text, window), "phrases").select(
        "phrase", F.coalesce("item_id", F.lit("")).alias("item_id")
    )
    blocks = max(1, -(-phrases.count() // block))
    carried = F.struct(*(keep or docs.columns)).alias("row")
    none = F.array().cast(RANGE)
    found = docs.select(carried, docs[text].alias("text"), F.lit(0).cast("long").alias("n_words"), none.alias("words"), none.alias("spans"), F.array().cast("array<string>").alias("items"))
    part = F.pmod(F.xxhash64("phrase", "item_id"), F.lit(blocks))
    for k in range(blocks):
        chosen = Phrases([tuple(r) for r in phrases.where(part == k).collect()])
        shared = spark.sparkContext.broadcast(chosen)
        found = found.mapInArrow(_search(shared), found.schema)
        if k < blocks - 1:
            found = written(found, "contamination")
            shared.destroy()
    covered = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + w["end"] - w["start"])
    return found.select("row", "n_words", covered.alias("n_hit"), "words", "spans", "items")


def _search(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, ranges, items = find_in_texts(texts, phrases)
            for name, out in (("words", ranges), ("items", items)):
                before = batch.column(name)
                if len(before.flatten()):
                    for mine, theirs in zip(out, before.to_pylist(), strict=True):
                        mine += theirs if name == "items" else [(r["start"], r["end"]) for r in theirs]
            ranges = [merged(r) for r in ranges]
            spans = [text_spans(t, r) if r else [] for t, r in zip(texts, ranges, strict=True)]
            pairs = lambda x: pa.array([[{"start": a, "end": b} for a, b in r] for r in x], _PAIRS)
            made = {
                "n_words": pa.array(counts, pa.int64()), "words": pairs(ranges), "spans": pairs(spans),
                "items": pa.array([sorted(set(i)) for i in items], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(k)) for k, n in enumerate(batch.schema.names)], batch.schema.names)

    return search


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_contamination(docs.select("doc_id", "text"), "text", items, "item_id", "text", keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(10, len(w)) AS k FROM items WHERE len(w) > 0))
), places AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), hits AS (SELECT rid, i, k, item_id FROM places JOIN windows USING (k, phrase)),
covered AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""
